"""Benchmark passages in documents, by a positional inverted index.

The index is a table of segments.  A segment holds the complete postings of some
whole documents: its distinct terms in order, and for every term the places
where it stands, coded as differences and compressed.  Segments are made, read and searched
independently, so the index is spread over as many tasks as there are segments
and no posting list is ever longer than a segment.

A phrase is looked up from its rarest term in the segment: the places of that
term, moved by its offset, are the candidates, and the lists of the next rarer
terms strike candidates out until all terms are matched.  A phrase with a term
that the segment lacks costs one lookup.  A bounded number of phrases is known to
all tasks; more phrases than that are routed to the segments that hold their rarest
term of the whole corpus.  Either way the index is read once.

Results by case: a null or empty text, or one without words, has no words and
contains nothing; an item without words finds nothing; equal phrases of several
items are looked up once and count for each; a null item_id is left out; repeated
rows each get their own result; an empty table gives no rows; only the id and text
columns are read (``clean_of`` carries the others along under any name); a long text is
a segment of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm import ragged
from weekloom.llm.scratch import fresh, partitions, small_batches, written

#: Phrases (or proximity queries) up to which every segment looks up all of them; more
#: are routed to segments.
BLOCK = 50_000

SEGMENT = (
    "segment string, ids array<{kind}>, doc_at array<int>, terms array<bigint>, term_at array<int>, deltas binary"
)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list cell holding ``values``."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


class Segment:
    """Terms, postings and document bounds of one stored segment."""

    def __init__(self, doc_at: np.ndarray, terms: np.ndarray, term_at: np.ndarray, deltas: np.ndarray):
        self.doc_at, self.terms, self.term_at = doc_at, terms, term_at
        places = np.cumsum(deltas, dtype=np.int64)
        count = np.diff(term_at)
        if len(terms):
            base = places[term_at[:-1]] - deltas[term_at[:-1]]
            places = places - np.repeat(base, count)
        self.places, self.count = places, count
        self.width = np.int64(doc_at[-1] + 1)
        #: (term, place) as one sorted number, for membership tests
        self.keys = np.repeat(np.arange(len(terms)), count) * self.width + places

    @staticmethod
    def columns(texts: ragged.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        found = ragged.words(texts, ragged.ALNUM, lower=True)
        hashes = found.hashes().view(np.int64)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        start = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.empty(0, np.int64)
        deltas = np.diff(order, prepend=0)
        deltas[start] = order[start]
        return found.at, ranked[start], np.r_[start, len(ranked)], deltas

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Numbers of the terms here, or -1."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        key = term * self.width + place
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return self.keys[at] == key

    def _rarest_first(self, terms: np.ndarray, size: np.ndarray):
        """Rows whose terms all stand here, their term numbers, and the order of rarity."""
        number = self.find(terms)
        used = np.arange(terms.shape[1]) < size[:, None]
        rows = np.flatnonzero((~used | (number >= 0)).all(axis=1) & (size > 0))
        number, used = number[rows], used[rows]
        rarity = np.where(used, self.count[np.maximum(number, 0)], np.int64(1) << 40)
        return rows, number, np.argsort(rarity, axis=1, kind="stable")

    def _candidates(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each entry of ``term`` all its places: entry numbers and places."""
        n = self.count[term]
        which = np.repeat(np.arange(len(term)), n)
        first = np.repeat(self.term_at[:-1][term] - np.r_[0, np.cumsum(n)[:-1]], n)
        return which, self.places[first + np.arange(len(which))]

    def phrases(self, terms: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``terms``, document, first place in the segment) of all occurrences."""
        rows, number, order = self._rarest_first(terms, size)
        if not len(rows):
            return rows, rows, rows
        r = np.arange(len(rows))
        which, place = self._candidates(number[r, order[:, 0]])
        start = place - order[which, 0]
        doc = np.searchsorted(self.doc_at, place, "right") - 1
        whole = (start >= self.doc_at[doc]) & (start + size[rows[which]] <= self.doc_at[doc + 1])
        which, start, doc = which[whole], start[whole], doc[whole]
        for k in range(1, terms.shape[1]):
            offset = order[which, k]
            needed = size[rows[which]] > k
            ok = ~needed
            ok[needed] = self.has(number[which[needed], offset[needed]], start[needed] + offset[needed])
            which, start, doc = which[ok], start[ok], doc[ok]
        return rows[which], doc, start

    def near(self, terms: np.ndarray, size: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, document, place of the rarest term) where every term of the row
        stands at most ``within`` words from that place, in the same document."""
        rows, number, order = self._rarest_first(terms, size)
        if not len(rows):
            return rows, rows, rows
        which, place = self._candidates(number[np.arange(len(rows)), order[:, 0]])
        doc = np.searchsorted(self.doc_at, place, "right") - 1
        for k in range(1, terms.shape[1]):
            needed = size[rows[which]] > k
            term = number[which, order[which, k]]
            low = np.maximum(place - within, self.doc_at[doc])
            high = np.minimum(place + within, self.doc_at[doc + 1] - 1)
            at = np.searchsorted(self.keys, term * self.width + low)
            at_least = self.keys[np.minimum(at, len(self.keys) - 1)]
            ok = ~needed | ((at < len(self.keys)) & (at_least <= term * self.width + high))
            which, place, doc = which[ok], place[ok], doc[ok]
        return rows[which], doc, place


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The segments of ``docs``, written to the shared folder."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for made, (part, texts) in enumerate(ragged.gathered(batches, "text")):
            at, terms, term_at, deltas = Segment.columns(texts)
            ids = part.column(0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{task}-{made}"]),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    _lists(at, pa.int32()),
                    _lists(terms, pa.int64()),
                    _lists(term_at, pa.int32()),
                    pa.array([ragged.packed(deltas.astype(np.int32))], pa.binary()),
                ],
                ["segment", "ids", "doc_at", "terms", "term_at", "deltas"],
            )

    return written(rows.mapInArrow(run, SEGMENT.format(kind=kind)), "index", large_rows=True)


def phrases_of(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(phrase, terms, item): every window of consecutive words of every item; an
    item of fewer words is one phrase.  ``phrase`` is a key of the terms."""
    rows = items.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in ragged.slices(batch, "text"):
                found = ragged.words(texts, ragged.ALNUM, lower=True)
                hashes = found.hashes().view(np.int64)
                first, size, owner = [], [], []
                for i in range(len(texts)):
                    a, b = found.at[i], found.at[i + 1]
                    if b > a:
                        n = max(b - a - window + 1, 1)
                        first.append(np.arange(a, a + n))
                        size.append(np.full(n, min(window, b - a)))
                        owner.append(np.full(n, i))
                if not first:
                    continue
                first, size, owner = (np.concatenate(x) for x in (first, size, owner))
                flat = hashes[np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())]
                terms = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([terms, part.column(0).take(pa.array(owner))], ["terms", "item"])

    made = rows.mapInArrow(run, "terms array<bigint>, item string")
    key = F.concat(F.hex(F.xxhash64("terms")), F.hex(F.xxhash64(F.lit(1), "terms")))
    return made.select(key.alias("phrase"), "terms", "item").distinct()


MATCH = "segment string, row int, phrase string, start int, size int"
_POSTINGS = ["doc_at", "terms", "term_at", "deltas"]


def _padded(terms: list) -> tuple[np.ndarray, np.ndarray]:
    """Terms of phrases as one matrix, and their sizes."""
    size = np.array([len(t) for t in terms])
    out = np.zeros((len(terms), size.max(initial=1)), np.int64)
    for row, mine in zip(out, terms, strict=True):
        row[: len(mine)] = mine
    return out, size


def _matches(segment: Segment, name: str, keys: pa.Array, terms: np.ndarray, size: np.ndarray, within: int | None) -> pa.RecordBatch:
    row, doc, place = segment.phrases(terms, size) if within is None else segment.near(terms, size, within)
    start = place - segment.doc_at[doc]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * len(row), pa.string()),
            pa.array(doc, pa.int32()),
            keys.take(pa.array(row, pa.int64())),
            pa.array(start, pa.int32()),
            pa.array(size[row], pa.int32()),
        ],
        ["segment", "row", "phrase", "start", "size"],
    )


def _segment(batch: pa.RecordBatch, row: int) -> Segment:
    doc_at, terms, term_at, deltas = (batch.column(batch.schema.get_field_index(n))[row] for n in _POSTINGS)
    numbers = (x.values.to_numpy(zero_copy_only=False) for x in (doc_at, terms, term_at))
    return Segment(*numbers, ragged.unpacked(deltas.as_py(), np.int32))


def _search_by_all(index: DataFrame, queries: DataFrame, within: int | None) -> DataFrame:
    """One pass in which every segment looks up all phrases, at most BLOCK of them."""
    rows = queries.collect()
    shared = index.sparkSession.sparkContext.broadcast((pa.array([r.phrase for r in rows], pa.string()), *_padded([r.terms for r in rows])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, terms, size = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                yield _matches(_segment(batch, i), batch.column(0)[i].as_py(), keys, terms, size, within)

    return index.select("segment", *_POSTINGS).mapInArrow(run, MATCH)


def _routed(index: DataFrame, queries: DataFrame) -> DataFrame:
    """(segment, phrase, terms): each phrase with the segments that hold its rarest term
    of the whole corpus.  A phrase with a term that no document has goes nowhere."""
    terms = queries.select("phrase", F.explode(F.array_distinct("terms")).alias("term"))
    places = F.posexplode("terms").alias("pos", "term")
    n = F.element_at("term_at", F.col("pos") + 2) - F.element_at("term_at", F.col("pos") + 1)
    held = index.select("segment", "term_at", places).select("segment", "term", n.cast("bigint").alias("n"))
    held = written(held.join(terms.select("term").distinct(), "term", "left_semi"), "postings")
    counts = held.groupBy("term").agg(F.sum("n").alias("n"))
    known = terms.join(counts, "term", "left").groupBy("phrase").agg(
        F.min_by("term", F.struct("n", "term")).alias("term"), F.bool_and(F.col("n").isNotNull()).alias("everywhere")
    )
    rarest = known.where("everywhere").select("phrase", "term")
    return rarest.join(held.select("segment", "term"), "term").join(queries, "phrase").select("segment", "phrase", "terms")


def _search_by_route(index: DataFrame, queries: DataFrame, within: int | None) -> DataFrame:
    """One pass in which a segment looks up the phrases that are routed to it; they
    follow the segment's row in its task, so no task holds more than a batch of them."""
    none = F.lit(None)
    here = index.select("segment", F.lit(0).alias("role"), *_POSTINGS, none.cast("string").alias("phrase"))
    asked = _routed(index, queries).select(
        "segment", F.lit(1).alias("role"), none.cast("array<int>").alias("doc_at"), "terms",
        none.cast("array<int>").alias("term_at"), none.cast("binary").alias("deltas"), "phrase",
    )
    dealt = here.unionByName(asked).repartition(partitions(index.sparkSession), "segment").sortWithinPartitions("segment", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, segment = None, None
        for batch in batches:
            names, roles = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            phrases, terms = batch.column(6), batch.column(3)
            i = 0
            while i < batch.num_rows:
                if roles[i] == 0:
                    name, segment = names[i], _segment(batch, i)
                    i += 1
                    continue
                end = i
                while end < batch.num_rows and roles[end] == 1 and names[end] == names[i]:
                    end += 1
                if names[i] == name:
                    mine = [terms[k].values.to_numpy() for k in range(i, end)]
                    yield _matches(segment, name, phrases.slice(i, end - i), *_padded(mine), within)
                i = end

    return dealt.mapInArrow(run, MATCH)


def _search(index: DataFrame, queries: DataFrame, within: int | None) -> DataFrame:
    """All matches of the distinct phrases in one pass over the index."""
    distinct = written(queries.dropDuplicates(["phrase"]).select("phrase", "terms"), "phrases")
    n = distinct.count()
    if not n:
        return index.sparkSession.createDataFrame([], MATCH)
    return (_search_by_all if n <= BLOCK else _search_by_route)(index, distinct, within)


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """(segment, row, phrase, start, size): all exact occurrences, ``start`` in
    words of the document."""
    return _search(index, phrases, None)


def proximity_matches(index: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """(segment, row, phrase, start, size): places of the phrase's rarest term with
    all its other terms at most ``within`` words away, in any order."""
    return _search(index, phrases, within)


def documents_of(index: DataFrame) -> DataFrame:
    """(segment, row, id, n_words) of every indexed document."""
    each = F.posexplode("ids").alias("row", "id")
    rows = index.select("segment", "doc_at", each)
    size = F.element_at("doc_at", F.col("row") + 2) - F.element_at("doc_at", F.col("row") + 1)
    return rows.select("segment", "row", "id", size.cast("bigint").alias("n_words"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 10) -> DataFrame:
    """(id, n_words, n_hit, items, contaminated) of every row: words that lie in
    an occurrence of any phrase of an item, and the items with occurrences."""
    index = build_index(docs, id_col, text_col)
    phrases = written(phrases_of(items, window), "windows")
    hits = written(phrase_matches(index, phrases), "hits")
    # words of the union of spans: what a span adds beyond the furthest end before it
    before = F.max(F.col("start") + F.col("size")).over(
        Window.partitionBy("segment", "row").orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    end = F.col("start") + F.col("size")
    new = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))))
    spans = hits.select("segment", "row", "start", "size").distinct()
    n_hit = spans.withColumn("new", new).groupBy("segment", "row").agg(F.sum("new").cast("bigint").alias("n_hit"))
    by_item = hits.select("segment", "row", "phrase").distinct().join(phrases.select("phrase", "item"), "phrase")
    named = by_item.groupBy("segment", "row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = documents_of(index).join(n_hit, ["segment", "row"], "left").join(named, ["segment", "row"], "left")
    none = F.array().cast("array<string>")
    return out.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items")
    ).withColumn("contaminated", F.col("n_hit") > 0)


def clean_of(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 10) -> DataFrame:
    """The rows of ``docs`` without benchmark passages.  Rows are told apart by
    id and text, so rows that repeat an id are judged each by itself."""
    mine, bad = fresh(docs, "row"), fresh(docs, "bad")
    id_, text = F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")
    key = F.concat(F.coalesce(id_, F.lit("-")), F.lit(":"), F.hex(F.xxhash64(text)), F.hex(F.xxhash64(F.lit(1), text)))
    keyed = docs.withColumn(mine, key)
    found = contamination(keyed, items, mine, text_col, window).where("contaminated")
    out = found.select(F.col(mine).alias(bad)).distinct()
    return keyed.join(out, F.col(mine) == F.col(bad), "left_anti").drop(mine)
