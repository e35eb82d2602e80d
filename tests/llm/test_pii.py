"""Personal data: plain spans against the stated patterns, disguised spans, offsets, redaction."""

import re
import time

from cases import EDGE, edge_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import pii, queries


def stated(text):
    """The patterns as they are written down, by plain finditer."""
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15],
    }


PIECES = st.sampled_from(["a@b.cd", "@", ".", "-", " ", "x", "é", "_", "+1 555", "1", "23", "255", "256.", "4539 1488 0343 6467", "4539148803436467", "(", "%"])


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_plain_spans(text):
    assert pii.detect(text) == stated(text)


def test_disguised_spans_map_back():
    for text, kind, found in [
        ("é mail bob (at) site dot com now", "email", "bob (at) site dot com"),
        ("bob[at]site[dot]org", "email", "bob[at]site[dot]org"),
        ("write to john at example dot com please", "email", "john at example dot com"),
        ("x bоb@еxаmple.com y", "email", "bоb@еxаmple.com"),
        ("x bob@exam\u200bple.com y", "email", "bob@exam\u200bple.com"),
        ("x bob@example.c\u200bom y", "email", None),
        ("call plus one five five five one two three four five six seven.", "phone", "plus one five five five one two three four five six seven"),
        ("four five three nine one four eight eight zero three four three six four six seven", "card", "four five three nine one four eight eight zero three four three six four six seven"),
        ("ip １９２.１６８.1.7 end", "ip", "１９２.１６８.1.7"),
        ("one nine two dot one six eight dot one dot seven", "ip", "one nine two dot one six eight dot one dot seven"),
    ]:
        plain = pii.detect(text)
        spans = [text[a:b] for a, b in pii.disguised(text, plain)[kind]]
        if found:
            assert spans == [found], text
        else:  # a plain span is there already; the disguise must not repeat it
            assert plain[kind] and not spans


def test_disguise_inside_an_identifier(spark):
    texts = [
        ("j\u043ehn.smith@example.com", "email", "hn.smith@example.com"),
        ("john@mail.ex\u0430mple.com", "email", "john@mail.ex"),
        ("bob@example.c\u200bom", "email", "bob@example.c"),
        ("+44 2079 46 \uff10958", "phone", "+44 2079 46"),
        ("jo\u200bhn@mail.ex\u0430mple.com", "email", "hn@mail.ex"),
    ]
    rows = {r.doc_id: r for r in pii.find_personal_data(edge_docs(spark, [(i, f"x {t} y") for i, (t, _, _) in enumerate(texts)])).collect()}
    for i, (t, kind, piece) in enumerate(texts):
        assert [(s.kind, f"x {t} y"[s.start:s.end]) for s in rows[i].plain] == [(kind, piece)]
        assert [(s.kind, f"x {t} y"[s.start:s.end]) for s in rows[i].added] == [(kind, t)]
        assert pii.redact(f"x {t} y") == f"x [{kind.upper()}] y"
    # Contained in the plain span: nothing to add.
    t = "\u0430 b@c.de"
    assert not any(pii.disguised(t, pii.detect(t), reaching=True).values()) and pii.redact(t) == "\u0430 [EMAIL]"


def test_mixed_at_and_dot():
    for t in [
        "jane at example [dot] com", "jane at example (dot) com", "jane (at) example dot com", "jane dot doe at example dot com", "jane  at  example\ndot com",
        "jane (dot) doe at example.com", "jane [dot] doe at mail dot example (dot) com", "jane dot doe@example.com", "jane\n(at)\nexample.com",
        "Jane DOT Doe AT Example DOT Com", "jane at mail.example dot com", "jane@example dot com", "jane\u00a0at example &#46; com",
    ]:
        assert pii.redact(f"- {t}, thanks") == "- [EMAIL], thanks", t
    for t in ["look at example.com", "a (dot) b, look at example.com, c (dot) d", "connect the dot at example.com", "a dot at noon", "dot dot dot"]:
        assert pii.redact(t) == t
    began = time.perf_counter()
    for t in ["a dot " * 60_000, "a dot at " * 60_000, "a dot b at c " * 40_000, "a" + " " * 300_000 + "dot", " (dot" * 60_000, "(dot) at " * 40_000, "(" + " " * 300_000 + " dot b"]:
        pii.disguised(t, pii.detect(t))
    assert time.perf_counter() - began < 20


def test_clean_text_has_no_spans():
    for text in ["look at example.com today", "one two three", "meet me at noon (at) home", "dot at dot", "seven eight nine ten dots"]:
        assert not any(pii.detect(text).values()) and not any(pii.disguised(text, pii.detect(text)).values())


def test_long_texts_take_linear_time():
    began = time.perf_counter()
    for text in ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + "." * 300_000, "one " * 60_000, "a at " * 60_000, "x (at " * 50_000]:
        plain = pii.detect(text)
        pii.disguised(text, plain)
    assert time.perf_counter() - began < 20


def test_operator(spark):
    extra = [(20, "a@b.cd and 1.2.3.4 or +1 555 123 4567"), (21, "bob (at) site (dot) org")]
    rows = {(r.doc_id, len(r.plain), len(r.added)) for r in pii.find_personal_data(edge_docs(spark, EDGE + extra)).collect()}
    assert {(20, 3, 0), (21, 0, 1), (0, 0, 0), (None, 0, 0)} <= rows
    clean = {r.doc_id: r for r in pii.redact_personal_data(edge_docs(spark, [*extra, (0, None)])).collect()}
    assert clean[20].text == "[EMAIL] and [IP] or [PHONE]" and clean[20].n_chars == len(clean[20].text)
    assert clean[21].text == "[EMAIL]" and clean[0].text is None and clean[0].n_chars == 0
    assert pii.find_personal_data(edge_docs(spark, [])).collect() == []


def test_query_digests(spark, tmp_path):
    edge_docs(spark, [(1, "b 1.2.3.4 a@b.cd"), (2, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    one, two = sorted(queries.QUERIES["op2_personal_data"](spark, str(tmp_path)).collect())
    assert one.spans == "email:10:16,ip:2:9" and one.n_email == 1 and one.n_ip == 1 and one.n_card == 0
    assert two.spans == "" and len(two.base_sha256) == 64
