"""Fill-in-the-middle texts against a restatement with strings."""

import hashlib
import random
import re
from collections import Counter

import pytest

from namewright.llm import fill_middle
from namewright.llm.fill_middle import TEXT, Piece


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(key, text, percent=90, spm=20):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    hexes = sha(f"1:{'' if key is None else key}")
    h = [int(hexes[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    low, high = sorted(x % (n + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(4)
    signs = ["a", "Zebra", " ", "\n", "é", "ß", "日本", "😀", "<", ">", "<P", "P>", "<S", "M>", "\x00", "1", "\r\n", "ﬀ", "Ａ"]
    made = ["".join(draw.choice(signs) for _ in range(draw.randrange(40))) for _ in range(300)]
    return [None, "", " ", "a", "é", "x<P>y", "<S>", "<M", "<", "no marks at all", "word " * 40_000, *made]


def test_outputs_equal_the_restatement(spark, texts):
    """Missing, empty, very long and marked texts, missing and repeated keys, columns with clashing names."""
    rows = [*enumerate(texts), (None, "no key here"), (None, None), (3, texts[3])]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'f' as form", "1 as n", "'o' as output").repartition(3)
    made = fill_middle.fill_in_middle(table)
    back = made.select("*", fill_middle.restored("output", "form").alias("back")).collect()
    got = Counter((r._doc.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.output_sha256) for r in back)
    want = Counter()
    for key, text in rows:
        n, form, prefix, middle, output = brute(key, text or "")
        want[(key, n, form, prefix, middle, output, sha(output))] += 1
    assert got == want
    assert all(r.back.text == (r._doc.text or "") and r.back.sha256 == sha(r._doc.text or "") for r in back)
    assert {r.form for r in back} == {"plain", "psm", "spm"} and {r._doc.form for r in back} == {"f"}
    assert fill_middle.fill_in_middle(table.limit(0)).collect() == []


def test_rates_are_parameters(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "id long, body string")
    forms = lambda **rates: {r.form for r in fill_middle.fill_in_middle(table, "id", "body", **rates).collect()}
    assert forms(percent=0) == {"plain"}
    assert forms(percent=100, spm_percent=0) == {"plain", "psm"} and forms(percent=100, spm_percent=100) == {"plain", "spm"}


def test_pieces_are_cut_and_come_back():
    raw = "aß<c".encode()
    parts = fill_middle.cut(fill_middle.cut([Piece(TEXT, 0, len(raw))], 3), 1)
    assert parts == [Piece(TEXT, 0, 1), Piece(TEXT, 1, 2), Piece(TEXT, 3, 2)]
    for form, output in (("psm", "<P>a<S><c<M>ß"), ("spm", "<S><c<P>a<M>ß")):
        pieces = fill_middle.arrange(dict(zip(fill_middle.PARTS, parts)), form)
        assert b"".join(fill_middle.spelled(pieces, raw)) == output.encode()
        back = fill_middle.restored_pieces(output.encode(), form)
        assert b"".join(fill_middle.spelled(back, output.encode())) == raw
        assert fill_middle.streamed_sha256(back, output.encode()) == hashlib.sha256(raw).hexdigest()
