"""Fill-in-the-middle: cuts, round trips over any pieces, edge cases, many rows of one document."""

from __future__ import annotations

import hashlib
import re

from hypothesis import given
from hypothesis import strategies as st

from lapidar.llm import fill_in_middle as fim

TEXT = st.text(alphabet=st.sampled_from(["a", "\n", "é", "𝕏", "<", "P", "S", "M", ">", "\r", " "]), max_size=40)


@given(TEXT, st.integers(0, 500), st.integers(1, 9))
def test_pieces_give_the_output_and_the_text_back(text, doc_id, piece):
    settings = fim.Settings(piece=piece)
    ends = fim.line_ends(text)
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert ends == [sum(map(len, units[: i + 1])) for i in range(len(units))]
    cut = fim.decided(doc_id, text, ends, settings)
    out = list(fim.assembled(text, ends, cut, piece))
    assert all(0 < len(p) <= max(piece, 3) for p in out)
    assert "".join(out) == brute_output(doc_id, text)[1]
    whole = "".join(out)
    for size in (1, 2, 3, 50):
        assert fim.restored([whole[i : i + size] for i in range(0, len(whole), size)], cut.form) == text


def brute_output(doc_id, text):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or re.search("<[PSM]>", text):
        return (len(units), "plain", None, None), text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if h4 % 100 < 50:
        return (len(units), "spm", len(prefix), len(middle)), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return (len(units), "psm", len(prefix), len(middle)), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_rows_match_brute_force(spark):
    texts = [None, "", "\n", "a", "a\nb", "x <P> y\nz", "é\r\n" * 4000, "one line " * 9000, "<\n<P\nS>\n" * 9, "a\nb", "\n\n\n"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "q\nr\n"), (4, "a\nb")] + [(77, f"k {i}\nl\nm") for i in range(60)]
    frame = spark.createDataFrame([(i, t, "f", 3, "m") for i, t in rows], "doc_id long, text string, form string, n int, _metadata string")
    for settings, partitions in ((fim.Settings(piece=50), 3), (fim.Settings(), None)):
        found = fim.transformed(spark, frame.repartition(4), settings, partitions)
        assert found.schema.simpleString() == f"struct<{','.join(c.replace(' ', ':').replace('long', 'bigint') for c in fim.ROWS.split(', '))}>"
        expected = []
        for i, t in rows:
            known, out = brute_output(i, t or "")
            digests = (hashlib.sha256(x.encode()).hexdigest() for x in (out, t or ""))
            expected.append((i, *known, *digests))
        assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    pieces = sorted(map(tuple, fim.texts(spark, frame.where("doc_id = 6"), fim.Settings(piece=900)).collect()), key=lambda r: r[2])
    assert "".join(p[3] for p in pieces) == brute_output(6, texts[6])[1] and len(pieces) > 10


def test_empty_table_and_other_settings(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert fim.transformed(spark, frame).count() == 0
    frame = spark.createDataFrame([(i, "a\nb\nc") for i in range(200)], "doc_id long, text string")
    forms = fim.transformed(spark, frame, fim.Settings(percent=40, spm_percent=0)).groupBy("form").count().collect()
    counts = {r["form"]: r["count"] for r in forms}
    assert set(counts) == {"plain", "psm"} and 50 < counts["psm"] < 110
