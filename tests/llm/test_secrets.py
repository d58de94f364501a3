import hashlib

from weekloom.llm.queries import QUERIES
from weekloom.llm.secrets import Ownership, scan_secrets, spans_text
from tests.conftest import SMALL
from tests.llm.brute import secrets

LIVE, COPIED = "Zk3Jq9Xv7Lm2Pw5Rt8Bn", "Ab1Cd2Ef3Gh4Ij5Kl6Mn"
ROWS = [
    (1, "a", f"é password = 'hunter22' and {LIVE} end"),
    (2, "a", f"x {COPIED} y token:abc API_KEY=\"{LIVE}\""),
    (3, "b", f"y {COPIED}"),
    (4, None, f"AKIA{'Q7' * 9} AKIAAKIA then {'0123456789abcdef' * 2}"),
    (5, "b", None),
    (6, "b", ""),
    (None, "c", "secret=password=abcdef passwd : api-key=1234567"),
    (7, "c", "paſsword=abcdefgh toKen=abcdefgh"),
    (8, "c", "w " * 100_000 + "Secret: aaaaaaaa"),
    (8, "c", "the same id with tokEN==abcdefg"),
    (3, "b", f"y {COPIED}"),
]


def got(df):
    return sorted(((r.doc_id, r.base, r.spans) for r in df.collect()), key=repr)


def run(spark, rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(d, o, t, 5) for d, o, t in rows], "doc_id bigint, source string, text string, spans int")
    found = scan_secrets(docs, rule=Ownership())
    base = spans_text(F.filter("spans", lambda s: s["kind"] < 3)).alias("base")
    return found.select("doc_id", base, spans_text(F.col("spans")).alias("spans"))


def test_spans_and_owners(spark):
    want = secrets(ROWS)
    assert got(run(spark, ROWS)) == want
    by_id = {d: s for d, _, s in want}
    assert "owned" in by_id[1] and "owned" not in by_id[2]


def test_values_copied_inside_one_source(spark):
    wide = [(100 + k, "a", f"x {COPIED} y") for k in range(11)]
    again = [(200, "a", f"x {LIVE} y")] * 11 + [(None, "a", f"z {LIVE}")]
    docs = spark.createDataFrame(wide + again, "doc_id bigint, source string, text string")
    out = {(r.doc_id, bool(r.spans), r.n_live, r.n_copied) for r in scan_secrets(docs).collect()}
    assert out == {(100 + k, False, 0, 1) for k in range(11)} | {(200, True, 1, 0), (None, True, 1, 0)}
    loose = scan_secrets(docs, rule=Ownership(docs=11)).collect()
    assert all((r.n_live, r.n_copied) == (1, 0) for r in loose)


def test_empty_table(spark):
    assert run(spark, []).collect() == []


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "text").collect()
    want = {d: (hashlib.sha256(b.encode()).hexdigest(), s) for d, b, s in secrets([tuple(r) for r in docs])}
    out = QUERIES["op7_secret_scan"](spark, SMALL).collect()
    assert {r.doc_id: (r.base_sha256, r.spans) for r in out} == want
    assert all(r.n_assign + r.n_access + r.n_hex == sum(s[:5] not in ("", "owned") for s in r.spans.split(",")) for r in out)


def test_query_counts_each_kind(spark, tmp_path):
    docs = [(d, o, t) for d, o, t in ROWS]
    spark.createDataFrame(docs, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op7_secret_scan"](spark, str(tmp_path)).collect()
    want = [(d, *(f",{b}".count(f",{kind}:") for kind in ("assign", "access", "hex"))) for d, b, _ in secrets(ROWS)]
    assert sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex) for r in out), key=repr) == sorted(want, key=repr)
