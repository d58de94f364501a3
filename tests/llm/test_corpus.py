"""Quality, decontamination, line dedup, language model, mixing and the pipeline
over odd rows, against plain versions."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import weekloom.llm.decontaminate as decontaminate_module
from weekloom.llm import ragged
from weekloom.llm.decontaminate import build_index, contamination, phrases_of, proximity_matches
from weekloom.llm.language_model import score_texts
from weekloom.llm.line_dedup import LineRuns, drop_common_lines
from weekloom.llm.mixing import fill, min_cost_flow, mix
from weekloom.llm.quality_classifier import Training, classify, estimate, pattern_votes
from weekloom.llm.quality_rules import BASE_FAILED, Risk, binomial_cdf, risk_controlled
from weekloom.session import stored
from tests.conftest import SMALL
from tests.llm.brute import common_lines, contaminated, low, quality_base, words

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, n_lines string, kept int"


def prose(k, n=60):
    rng = np.random.default_rng(k)
    return " ".join(f"word{i}" + ("." if i % 9 == 0 else "") for i in rng.integers(0, 500, n))


PASSAGE = " ".join(f"bench{i}" for i in range(24))
ODD = [
    (1, prose(1), "en", "a"), (2, prose(2) + "\n" + prose(2), "en", "b"), (3, None, None, None), (4, "", "en", "a"), (5, " \n\t\n", "de", "a"),
    (6, "Été " * 40 + "\n shared LINE \nx", "de", None), (None, prose(3), "en", "b"), (None, None, None, "c"),
    (7, prose(4) + " " + PASSAGE + ", " + PASSAGE.upper(), "en", "c"), (8, "short words\nshared line", "en", "c"),
    (8, prose(5), "en", "c"), (1, prose(1), "en", "a"), (9, "##|| " * 30, "en", "b"), (10, "a\x00b " + PASSAGE[:80], "en", "b"),
    (11, prose(6, 60_000), "en", "a"), *((20 + k, f"\tShared line\n{prose(40 + k)}", "en", "a") for k in range(12)),
]
ITEMS = [(1, PASSAGE), (2, "word1 word2"), (3, None), (None, prose(1)), (4, "  "), (5, PASSAGE), (6, prose(4))]


@pytest.fixture(scope="module")
def docs(spark):
    return table_of(spark, ODD)


def table_of(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), "clash", "clash", 0) for r in rows], SCHEMA).repartition(3)


def texts(rows):
    return [(r[0], r[1]) for r in rows]


def test_binomial_and_rules(spark, docs):
    for k, n, p in ((0, 10, 0.3), (3, 40, 0.1), (700, 1000, 0.7), (5, 5, 0.5), (20, 9000, 0.004)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if n < 1000 else None
        if exact is not None:
            assert binomial_cdf(k, n, p) == pytest.approx(min(exact, 1.0), rel=1e-9)
    good = [(1000 + k, prose(k), "en", "a") for k in range(900)]
    labels = spark.createDataFrame([(d, 1, 0) for d, *_ in good] + [(1000, 0, 0), (None, 1, 0), (9, 0, 0), (77, 1, 0)], "doc_id bigint, quality int, toxic int")
    out = risk_controlled(table_of(spark, ODD + good), labels, risk=Risk(0.06, 0.05)).collect()
    got = sorted(((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in out), key=repr)
    assert got == sorted(((d, quality_base(t)) for d, t in texts(ODD + good)), key=repr)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in out) and BASE_FAILED
    assert "symbols_per_word" in next(r for r in out if r.doc_id == 9).rejected_by
    assert sum(not r.kept for r in out if (r.doc_id or 0) >= 1000) <= 0.06 * 900
    none = risk_controlled(docs, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in none) and len(none) == len(ODD)
    assert risk_controlled(docs.limit(0), labels).collect() == []


@pytest.mark.parametrize("block", [50_000, 7])
def test_decontamination(spark, docs, monkeypatch, block):
    monkeypatch.setattr(decontaminate_module, "BLOCK", block)
    monkeypatch.setattr(ragged, "SLICE_BYTES", 3000)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    out = contamination(docs, items).collect()
    want = contaminated(texts(ODD), ITEMS)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in out), key=repr) == want
    assert any(h for _, _, h, _ in want)
    assert not any(r.contaminated for r in contamination(docs, items.limit(0)).collect())
    assert contamination(docs.limit(0), items).collect() == []


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x x blue x green"), (2, "blue red green"), (3, "red x x x x x blue green")], "doc_id bigint, text string")
    found = proximity_matches(build_index(docs), phrases_of(spark.createDataFrame([(1, "green blue red")], "item_id bigint, text string"), 10), 5)
    assert found.count() == 2


def test_index_is_read_one_segment_at_a_time(spark):
    rows = [(k, "some words " * 140_000) for k in range(5)]
    index = build_index(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1))
    groups = [m.row_group(k).num_rows for f in index.inputFiles() for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for k in range(m.num_row_groups)]
    assert len(groups) > 3 and set(groups) == {1}
    assert index.schema["deltas"].dataType.simpleString() == "binary"
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 1 << 20


def test_texts_of_small_batches_go_together():
    batches = [pa.RecordBatch.from_pydict({"id": [k, k], "text": ["x" * 60, None]}) for k in range(10)]
    got = list(ragged.gathered(batches, "text", 300))
    assert [i for part, _ in got for i in part.column(0).to_pylist()] == [k for k in range(10) for _ in "ab"]
    assert [len(texts.data) for _, texts in got] == [180, 180, 180, 60] and not list(ragged.gathered([], "text"))
    for values in (np.array([], np.int32), np.array([0, -1, 1 << 30, 7], np.int32), np.arange(300, dtype=np.uint64) << 50):
        assert (ragged.unpacked(ragged.packed(values), values.dtype) == values).all()


@pytest.mark.parametrize("first", [False, True])
def test_line_dedup(spark, docs, first):
    out = drop_common_lines(docs, keep_first=first, batches=1 if first else 3).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out), key=repr) == common_lines(texts(ODD), 10, first)
    assert drop_common_lines(docs.limit(0)).collect() == []


def test_line_runs_are_compacted(spark):
    runs = LineRuns(spark, min_docs=3, fanout=2)
    for k in range(5):
        rows = [(10 * k + i, [b"every", bytes([k])]) for i in range(2)]
        runs.add(spark.createDataFrame(rows, "id bigint, hashes array<binary>"))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert [(bytes(r.hash), r.first_id) for r in runs.common().collect()] == [(b"every", 0)]


def test_language_model(spark, docs):
    rows = ODD + [(2000 + k, prose(k % 7), "en", "a") for k in range(60)]
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0 for d, *_ in rows}
    tokens = [(d, [*words(low(t)), None]) for d, t in texts(rows)]
    count = Counter(w for d, ws in tokens if not held[d] for w in ws)
    total, distinct = sum(count.values()), len(count)
    want = [(d, held[d], len(ws), sum(count[w] > 0 for w in ws), total, sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)) for d, ws in tokens]
    out = score_texts(table_of(spark, rows)).collect()
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out), key=repr)
    for a, b in zip(got, sorted(want, key=repr), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert score_texts(docs.limit(0)).collect() == []
    assert len(score_texts(docs, held_out=F.lit(True)).collect()) == len(ODD)


def test_words_depend_on_what_stands_before_them(spark):
    from weekloom.llm.language_model import FORMS, HEADS, NEAR, SMOOTH, _form, Training

    rng = np.random.default_rng(5)
    rows = [(k, " ".join(f"w{i}" + "x" * (i % 7) + "é" * (i % 3 < 1) for i in np.minimum(rng.geometric(0.06, 40), 60).tolist())) for k in range(120)]
    rows += [(200, None), (201, ""), (202, "w1x w1x"), (203, rows[3][1]), (203, rows[3][1]), (None, rows[5][1])]
    rows += [(300 + k, f"new{k} w1x newer{k} w2xx new{k} another-one") for k in range(40)]
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0 for d, _ in rows}
    rows = [(d, t) for d, t in rows if held[d] or "new" not in (t or "")]
    tokens = [(d, [*words(low(t or "")), None]) for d, t in rows]

    def form(w):
        raw = np.frombuffer((w or "").encode(), np.uint8)
        return 0 if w is None else int(_form(raw, np.array([0]), np.array([len(raw)]))[0])

    trained = [ws for d, ws in tokens if not held[d]]
    count = Counter(w for ws in trained for w in ws)
    (*heads, after_them) = count.most_common(HEADS + 1)
    assert heads[-1][1] > after_them[1] and len(count) <= NEAR and any(held[d] and set(ws) - set(count) for d, ws in tokens)
    heads = {w for w, _ in heads}
    rest = [[c for w, c in count.items() if w not in heads and form(w) == f] for f in range(FORMS)]

    def kind(w):
        return ("head", w) if w in heads else form(w)

    def before(w):
        return ("word", w) if w in count else form(w)

    def pairs(ws):
        return list(zip(ws, ["begin", *map(before, ws[:-1])], strict=True))

    met = Counter(p for ws in trained for p in pairs(ws))
    after = Counter((kind(w), b) for ws in trained for w, b in pairs(ws))

    def own(w):
        return 1.0 if w in heads else (count[w] + SMOOTH) / (sum(rest[form(w)]) + SMOOTH * (len(rest[form(w)]) + 1))

    def gain(ws, prior):
        return sum(math.log10((met[w, b] + prior * own(w)) / (after[kind(w), b] + prior)) - math.log10(own(w)) for w, b in pairs(ws))

    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5, F.col("text")).cache()

    def scores(prior):
        return sorted(((r.doc_id or -1, r.n_tokens, r.score) for r in score_texts(docs, how=Training(prior=prior)).collect()))

    want = sorted((d or -1, len(ws), gain(ws, 7.0)) for d, ws in tokens)
    for a, b, c in zip(scores(7.0), scores(1e15), want, strict=True):
        assert a[:2] == b[:2] == c[:2] and a[2] - b[2] == pytest.approx(c[2], abs=1e-4)
    assert max(abs(c[2]) for c in want) > 1
    # over a class and one unseen word, the words after anything have probability 1
    for k, b in after:
        own_of = [(w, own(w)) for w in count if kind(w) == k] + ([] if isinstance(k, tuple) else [(object(), SMOOTH / (sum(rest[k]) + SMOOTH * (len(rest[k]) + 1)))])
        assert sum((met[w, b] + 7.0 * p) / (after[k, b] + 7.0) for w, p in own_of) == pytest.approx(1)


def test_chunks_are_read_one_at_a_time(spark, monkeypatch):
    from weekloom.llm import language_model

    kept = {}

    def written(df, name, **how):
        kept[name] = stored(df, name, **how)
        return kept[name]

    monkeypatch.setattr(language_model, "written", written)
    docs = spark.createDataFrame([(k, "some words " * 140_000) for k in range(12)], "doc_id bigint, text string").coalesce(1)
    assert score_texts(docs).count() == 12
    chunks = kept["chunks"]
    groups = [m.row_group(k).num_rows for f in chunks.inputFiles() for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for k in range(m.num_row_groups)]
    assert len(groups) > 3 and set(groups) == {1}
    assert {c: chunks.schema[c].dataType.simpleString() for c in language_model.PACKED} == dict.fromkeys(language_model.PACKED, "binary")


def test_flow_prefers_few_repeats():
    # pattern 0 is in both sources, pattern 1 only in the second
    assert min_cost_flow([100, 100], [[0, 1], [1]], [100, 100], 2) == [100, 100]
    assert min_cost_flow([100, 50], [[0, 1], [1]], [150, 80], 2) == [180, 50]
    assert fill([10, 1000, 1000], [5, 2, 1], 1200, 2) == pytest.approx([20, 786.6666666, 393.3333333])
    assert fill([10, 10], [5, 2], 60, 2) == [20, 20]


def test_mix(spark, docs):
    out = mix(docs, F.array("source")).collect()
    assert len(out) == len(ODD)
    by = {}
    for r in out:
        assert r.size == len(words(r.text)) and 0 <= r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        assert rows[0].source_size == sum(r.size for r in rows)
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 2
    assert sorted(map(repr, mix(docs.repartition(5), F.array("source")).collect())) == sorted(map(repr, out))
    assert mix(docs.limit(0), F.array("source")).collect() == []
    shared = mix(docs, F.when(F.col("doc_id") < 8, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array("source"))).collect()
    assert sum(r.taken for r in shared) == pytest.approx(1.5 * sum(r.size for r in shared), abs=3)


def test_mix_of_more_sources_than_any_driver_list(spark):
    n = 100_001
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.col("id").cast("string").alias("source"))
    got = mix(docs, F.array("source")).agg(F.count("*"), F.sum("size"), F.sum("taken"), F.max(F.abs(F.col("taken") - F.col("target")))).first()
    assert got[:2] == (n, 4 * n) and abs(got[2] - 6 * n) <= 1 and got[3] <= 1


def test_mix_by_component(spark):
    rows = [(k, f"w{k} " * (k % 11 + 1), "en", "s") for k in range(400)]
    names = [["a"], ["a", "b"], ["b"], ["c"], ["d", "e"], ["f"], ["e", "g"], ["d"], [], [None]]
    of = F.element_at(F.array(*[F.array(*[F.lit(x).cast("string") for x in p]).cast("array<string>") for p in names]), (F.col("doc_id") % 10 + 1).cast("int"))
    out = mix(table_of(spark, rows), of).collect()
    sizes, taken = Counter(), Counter()
    for r in out:
        sizes[tuple(r.pattern)] += r.size
        taken[tuple(r.pattern)] += r.taken
    order = [*"abcdefg", None]
    own = [sum(v for p, v in sizes.items() if x in p) for x in order]
    targets = fill(own, [(5.0, 2.0, 1.0)[k % 3] for k in range(8)], 1.5 * sum(v for p, v in sizes.items() if p), 2)
    quotas = np.diff(np.rint(np.cumsum([0.0, *targets])).astype(int)).tolist()
    for r in out:
        if r.pattern:
            assert (r.source_size, r.target) == (own[order.index(r.pattern[0])], pytest.approx(targets[order.index(r.pattern[0])]))
    found = sorted(sizes, key=repr)
    want = min_cost_flow([sizes[p] for p in found], [[order.index(x) for x in p] for p in found], quotas, 2)
    assert sum(want) == sum(taken.values()) and taken[()] == 0
    for p, t in zip(found, want, strict=True):
        if p in {("c",), ("f",), (None,)}:
            assert taken[p] == t
    extra = [sum(max(0, t - sizes[p]) for p, t in zip(found, ts, strict=True)) for ts in (want, [taken[p] for p in found])]
    assert extra[0] == extra[1]


def test_weak_labels(spark):
    votes = pattern_votes(np.arange(3**10))
    rng = np.random.default_rng(5)
    good = rng.random(30_000) < 0.8
    cast = np.where(rng.random((30_000, 10)) < np.where(good[:, None], 0.02, 0.45), -1, np.where(rng.random((30_000, 10)) < 0.5, 1, 0))
    code = ((cast + 1) * 3 ** np.arange(10)).sum(axis=1)
    used, back, n = np.unique(code, return_inverse=True, return_counts=True)
    posterior, table = estimate(votes[used], n.astype(float))
    assert ((posterior[back] > 0.5) == good).mean() > 0.97
    assert table[0, :, 0] == pytest.approx(np.full(10, 0.45), abs=0.03)


def test_classifier(spark, docs):
    held = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    out = {r.doc_id: r for r in classify(held).collect()}
    right = [out[d].kept == (q == 1) for d, q in labels.items() if d in out]
    assert sum(right) / len(right) > 0.9
    odd = classify(docs, how=Training(rounds=1)).collect()
    assert len(odd) == len(ODD) and not any(r.kept for r in odd if r.doc_id in (3, 4, 5))
    assert classify(docs.limit(0)).collect() == []


def test_pipeline_stages(spark, docs, tmp_path):
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "source_mix"]
    for name, stage in stages.items():
        kept = stage(spark, docs, str(tmp_path)).collect()
        none = stage(spark, docs.limit(0), str(tmp_path))
        assert none.collect() == []
        if name != "source_mix":
            assert none.columns == docs.columns
        if name == "line_dedup":
            assert sum("hared" in (r.text or "") for r in kept) == 1 and {r.n_lines for r in kept} == {"clash"}
            assert {r.n_chars == len(r.text or "") for r in kept} == {True}
        if name == "decontamination":
            bad = {d for d, _, hit, _ in contaminated(texts(ODD), ITEMS) if hit}
            assert len(kept) == sum(d not in bad for d, *_ in contaminated(texts(ODD), ITEMS))
        if name == "source_mix":
            assert all(r.taken > 0 for r in kept)


def test_lines_of_long_documents(spark):
    rng = np.random.default_rng(9)
    rows = [(k, "\n".join(rng.choice(["Common one", "common TWO ", "", f"own {k}", f"rare {k % 3}"], 400)), None, None) for k in range(14)]
    rows += [(50, "\n".join(["common two"] * 64 + ["x"] + ["common one"] * 63), None, None), (51, "\n" * 130, None, None)]
    for keep_first in (False, True):
        out = drop_common_lines(table_of(spark, rows), keep_first=keep_first, batches=1).collect()
        assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out), key=repr) == common_lines(texts(rows), 10, keep_first)


def test_word_counts_beyond_packed_numbers(spark):
    from weekloom.llm.language_model import _blocks, _classes, _counted, _known

    most = 2**31 - 1
    rows = [((1 << 36) + k, [5, -7, 9 + k], [0, 1, 2], [most, 1, 0]) for k in range(12)]
    chunks = spark.createDataFrame(rows, "chunk bigint, vocab array<bigint>, form array<int>, counted array<int>")
    blocks = _blocks(chunks, 3)
    counted = _counted(blocks, 3)
    found = {r.chunk: {p: c for x in r.known for p, c in zip(x.pos, x.counts)} for r in _known(blocks, counted, 3).collect()}
    assert found == {(1 << 36) + k: {0: 12 * most, 1: 12} for k in range(12)} and 12 * most > 2**34
    classes = _classes(counted)
    assert (classes.total, classes.distinct, sorted(classes.heads.tolist())) == (12 * most + 12, 2, [-7, 5])


def test_many_phrases_take_one_pass_over_the_index(spark, docs, monkeypatch):
    items = spark.createDataFrame([(k, prose(500 + k)) for k in range(300)] + [(9000, PASSAGE)], "item_id bigint, text string")
    phrases = phrases_of(items, 10)
    index = build_index(docs)
    whole = {tuple(r) for r in decontaminate_module.phrase_matches(index, phrases).collect()}
    near = {tuple(r) for r in proximity_matches(index, phrases, 30).collect()}
    monkeypatch.setattr(decontaminate_module, "BLOCK", 5)
    routed = decontaminate_module.phrase_matches(index, phrases)
    assert phrases.select("phrase").distinct().count() > 5000
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("deltas") and plan.count("MapInArrow") == 1
    assert {tuple(r) for r in routed.collect()} == whole and whole
    assert {tuple(r) for r in proximity_matches(index, phrases, 30).collect()} == near
