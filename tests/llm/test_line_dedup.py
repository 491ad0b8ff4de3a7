"""Line dedup against a plain Python version."""

import hashlib

from afterglow.llm import line_dedup
from afterglow.llm.catalogue import OP5_SQL

WS = " \t\n\x0b\x0c\r"


def brute(texts, k):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WS))
    seen = {}
    for i, t in enumerate(texts):
        for line in (t or "").split("\n"):
            seen.setdefault(key(line), set()).add(i)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) and len(seen[key(x)]) >= k)]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


TEXTS = [None, "", "\n\n", " A b \nx\n", "a B\ny", "É a\r\nA B\t", "a b\na b\nA b\nz", "é a\nİI\nx", "x \nx", "\n" + "q\n" * 5000, "last"]


def test_lines_match_brute_force(spark):
    df = spark.createDataFrame([(i if i else None, t, i, "k") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_lines int, __kept string")
    got = sorted(line_dedup.drop_common_lines(df, 3).collect(), key=lambda r: r.doc_id or 0)
    assert [(r.kept_text, r.n_lines, r.n_dropped) for r in got] == brute(TEXTS, 3)
    assert got[0].asDict()["__kept"] == "k" and "text" in got[0].asDict()


def test_repeated_rows_are_one_document(spark):
    df = spark.createDataFrame([(1, "a\nb")] * 5 + [(2, "a")], "doc_id long, text string")
    assert {r.n_dropped for r in line_dedup.drop_common_lines(df, 3).collect()} == {0}
    got = line_dedup.drop_common_lines(df, 2).collect()
    assert len(got) == 6 and {(r.doc_id, r.kept_text) for r in got} == {(1, "b"), (2, "")}


def test_empty_table(spark):
    assert line_dedup.drop_common_lines(spark.createDataFrame([], "doc_id long, text string"), 2).collect() == []


def test_sql_oracle(spark, tmp_path):
    import duckdb

    rows = [(i, "Shared line\n own " + str(i) + "\n\tSHARED LINE ") for i in range(12)] + [(50, None), (51, "shared line x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = sorted(con.sql(OP5_SQL).fetchall())
    got = line_dedup.drop_common_lines(df, 10).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got) == want
