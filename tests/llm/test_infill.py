"""Fill-in-the-middle: against the pattern's own matches, SQL, and an exact round trip."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecraft.llm import infill as I
from tests.conftest import SF_MID, SF_SMALL

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SHAPE = "doc_id long, text string"


def expected(doc_id, text):
    """Plain Python, straight from the definition."""
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    assert "".join(units) == text
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", text, None, None
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return len(units), "spm", f"<S>{suf}<P>{pre}<M>{mid}", len(pre), len(mid)
    return len(units), "psm", f"<P>{pre}<S>{suf}<M>{mid}", len(pre), len(mid)


def test_marks_select_every_place():
    rng = np.random.default_rng(3)
    bits = rng.random(8 * 50) < 0.3
    bits[80:160] = False                                          # whole words without a mark
    marks = I.Marks((bits * 0x80).astype(np.uint8).view("<u8"))
    at = np.flatnonzero(bits)
    assert (marks.select(np.arange(1, len(at) + 1)) == at).all()
    assert (marks.rank(np.arange(len(bits) + 1)) == np.concatenate([[0], np.cumsum(bits)])).all()


def test_space_marks_of_all_bytes():
    every = np.arange(256, dtype=np.uint8)
    for shift in range(8):                                        # each byte at each place of a word, beside all others
        data = np.roll(every, shift)
        got = I._space_marks(data.view("<u8")).view(np.uint8)
        assert (got == np.where(np.isin(data, [9, 10, 11, 12, 13, 32]), 0x80, 0)).all()


WILD = ["", None, " ", "\t\n", "a", " a ", "a b", "ä ö ü x", "日本 語\n\n語 ", "x" * 100_000, "w " * 30_000, "no <P> here", "<S>", "<M> a",
        "\x1f\x0e a\x08b", "🙂 🙂\t🙂", "< P> <P", "a\x00b c", " em  space", "é combining", "tail  ", "  head"]


def test_wild_texts(spark):
    rows = [(i, t) for i, t in enumerate(WILD * 12)] + [(None, "null id a b c"), (-5, "minus"), (2 ** 62, "big id here")]
    got = I.transform(spark.createDataFrame(rows, SHAPE)).withColumn("back", I.restore(F.col("output"), F.col("form"))).collect()
    texts = {i: t or "" for i, t in rows}
    assert len(got) == len(rows) and {r.form for r in got} == {"plain", "spm", "psm"}
    for r in got:
        assert (r.n, r.form, r.output, r.prefix_chars, r.middle_chars) == expected(r.doc_id, texts[r.doc_id])
        assert r.back == texts[r.doc_id]


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_equals_definition(spark, sf):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = I.op13_infill(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        n, form, out, p, m = expected(r.doc_id, docs[r.doc_id])
        assert tuple(r) == (r.doc_id, n, form, p, m, sha(out), sha(docs[r.doc_id] or ""))


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    cur = con.execute(I.OP13_SQL)
    names = [c[0] for c in cur.description]
    want = sorted(tuple(r) for r in cur.fetchall())
    assert sorted(tuple(r) for r in I.op13_infill(spark, SF_SMALL).select(*names).collect()) == want


def test_edges(spark):
    empty = I.transform(spark.createDataFrame([], SHAPE))
    assert empty.count() == 0
    df = spark.createDataFrame([(1, "a b", "x", 7)] * 3 + [(2, None, None, None)], SHAPE + ", Output string, N int")
    got = I.transform(df)
    assert got.columns == ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"]
    assert got.count() == 4 and got.where("doc_id = 1").distinct().count() == 1
    named = I.transform(df.withColumnRenamed("text", "my text"), text_col="my text").where("doc_id = 1").first()
    assert named.n == 2
