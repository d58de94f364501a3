"""The dealt operators over their whole tables, with the SQL twins that can be
written.  A query only renames and digests what its operator returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.decontaminate import contamination
from weekloom.llm.fill_in_middle import fill_in_middle, restored
from weekloom.llm.language_model import score_texts
from weekloom.llm.line_dedup import drop_common_lines
from weekloom.llm.mixing import mix
from weekloom.llm.near_dup import Shape, near_duplicates
from weekloom.llm.prefix_trie import grafted, prefix_trie
from weekloom.llm.quality_classifier import classify
from weekloom.llm.quality_rules import risk_controlled
from weekloom.llm.scratch import table
from weekloom.llm.secrets import KINDS, scan_secrets, spans_text
from weekloom.llm.suffix_dedup import without_repeats
from weekloom.llm.token_count import token_counts

from weekloom.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_duplicates(docs, shape=Shape(shingle=2))


@_query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risk_controlled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select(*base, F.concat_ws(",", "rejected_by").alias("rejected_by"))


@_query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_common_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


_KEY = (
    "translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),"
    " 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
ORACLES["op6_line_dedup"] = f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
  from documents),
keyed as (select doc_id, pos, line, {_KEY} as key from lines),
common as (select key from keyed where key <> '' group by key having count(distinct doc_id) >= 10),
marked as (select k.*, c.key is not null as gone from keyed k left join common c on k.key = c.key)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id"""


@_query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, F.array("source")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op10_source_mix"] = """
with sized as (
  select doc_id, coalesce('s' || source, '~') as source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::bigint as size
  from documents),
keyed as (select *, md5('17:' || coalesce(doc_id::varchar, '') || ':' || size) as key from sized),
per as (
  select source, sum(size)::bigint as source_size, 2 * sum(size)::double as top,
         ([5.0, 2.0, 1.0])[((row_number() over (order by source) - 1) % 3 + 1)::int]::double as weight
  from sized group by source),
ranked as (
  select *, 1.5 * sum(source_size) over () as total,
         row_number() over (order by top / weight, source) as k,
         sum(top) over (order by top / weight, source) - top as filled,
         sum(weight) over () - sum(weight) over (order by top / weight, source) + weight as open
  from per),
level as (select arg_min((total - filled) / open, k) filter (where top * open > (total - filled) * weight) as unit from ranked),
targets as (select source, source_size, case when unit is null then top else least(top, unit * weight) end as target from ranked, level),
quotas as (
  select *, (round_even(sum(target) over (order by source), 0) - round_even(coalesce(sum(target) over (
           order by source rows between unbounded preceding and 1 preceding), 0), 0))::bigint as quota
  from targets),
plan as (
  select *, least(quota, 2 * source_size) // greatest(source_size, 1) as whole,
         least(quota, 2 * source_size) % greatest(source_size, 1) as rest
  from quotas),
run as (
  select k.*, p.source_size, p.target, p.whole, p.rest,
         sum(size) over (partition by k.source order by key) as above,
         sum(size) over (partition by k.source, key) as tied, count(*) over (partition by k.source, key) as ties
  from keyed k join plan p on k.source = p.source)
select doc_id, size, source_size, target,
       (size * whole + case when above <= rest then size when above - tied <= rest then (rest - above + tied) // ties else 0 end)::bigint as taken
from run"""


@_query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLES["op5_decontamination"] = f"""
with docs as (select doc_id, {_WORDS} as w from documents),
items as (select item_id::varchar as item, {_WORDS} as w from benchmark where item_id is not null),
sizes as (select unnest(range(1, 11)) as size),
phrases as (
  select distinct item, least(10, len(w)) as size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as phrase
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)),
used as (select distinct size from phrases),
places as (
  select doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') as phrase
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from docs, used where len(w) >= size)),
hits as (select p.doc_id, p.i, p.size, f.item from places p join phrases f on p.phrase = f.phrase and p.size = f.size),
covered as (select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(i, i + size)) as word from hits) group by doc_id),
named as (select doc_id, count(distinct item) as n_items, sha256(array_to_string(list_sort(list_distinct(list(item))), ',')) as s from hits group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(c.n_hit, 0)::bigint as n_hit, coalesce(n.n_items, 0)::bigint as n_items,
       coalesce(n.s, sha256('')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated
from docs d left join covered c on d.doc_id = c.doc_id left join named n on d.doc_id = n.doc_id"""


@_query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(kind: int) -> F.Column:  # a second parameter of the filter's function would be the place in the array
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    digest = F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *map(count, range(3)), digest, spans_text(F.col("spans")).alias("spans"), "n_live", "n_copied")


@_query
def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = round_trip(spark, table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op1_warc_round_trip"] = """
with p as (select page_id, octet_length(encode(coalesce(html, '')))::bigint as n, sha256(coalesce(html, '')) as d from pages),
f as (select *, case when n >= 100 then min(page_id) over (partition by d) else page_id end as first from p)
select page_id, n as payload_bytes, d as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id = first then null else first end as refers_to
from f"""


@_query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digests = {"output_sha256": F.col("output"), "restored_sha256": restored(F.col("output"), F.col("form"))}
    columns = [F.sha2(text.cast("binary"), 256).alias(name) for name, text in digests.items()]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *columns)


ORACLES["op12_fill_in_middle"] = """
with keyed as (select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(doc_id::varchar, '')) as key from documents),
drawn as (
  select *, length(text)::bigint as n, ('0x' || key[1:8])::bigint as h1, ('0x' || key[9:16])::bigint as h2,
         ('0x' || key[17:24])::bigint as h3, ('0x' || key[25:32])::bigint as h4
  from keyed),
cut as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
              when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from drawn),
parts as (select *, substring(text, 1, a) as prefix, substring(text, a + 1, b - a) as middle, substring(text, b + 1, n - b) as suffix from cut)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from parts"""


@_query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(grafted(table(spark, sf_dir, "conversations")))


ORACLES["op13_prefix_trie"] = """
with cells as (
  select conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as id,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::bigint as w
  from conversations where conv_id is not null),
own as (
  select conv_id, list(id order by turn nulls first, id) as ids, list(w order by turn nulls first, id) as ws from cells group by conv_id),
bits as (
  select conv_id, unnest(range(8 * len(conv_id::varchar))) as k, conv_id::varchar as c from own),
streams as (
  select conv_id, list((ascii(c[(k // 8 + 1)::int]) >> (k % 8)::int) & 1 order by k) as b from bits group by conv_id),
crc as (
  select conv_id, xor(list_reduce(list_concat([4294967295::bigint], list_transform(b, lambda x: x::bigint)),
                  lambda c, x: xor(c >> 1, 3988292384::bigint * (xor(c, x) & 1))), 4294967295::bigint) as crc
  from streams),
paths as (
  select o.conv_id, list_concat(coalesce(b.ids, [])[1:(crc % 4)::int], o.ids[(crc % 4)::int + 1:]) as ids,
         list_concat(coalesce(b.ws, [])[1:(crc % 4)::int], o.ws[(crc % 4)::int + 1:]) as ws
  from own o join crc on o.conv_id = crc.conv_id left join own b on b.conv_id = o.conv_id - o.conv_id % 20),
steps as (
  select conv_id, d, md5(array_to_string(ids[1:d], ',')) as node, case when d > 0 then md5(array_to_string(ids[1:d - 1], ',')) end as parent,
         case when d > 0 then ws[d] else 0 end as w, d = len(ids) as ends
  from (select *, unnest(range(len(ids) + 1))::int as d from paths)),
nodes as (
  select node, min(parent) as parent, min(d) as depth, min(conv_id) as conv_id, count(*) as n_convs, min(w) as w,
         coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '') as ended
  from steps group by node),
kids as (select parent as node, count(*) as n_children from nodes where parent is not null group by parent),
below as (
  select s.node, count(*) filter (where k.node is null) as n_leaves, sum((n.n_convs - 1) * n.w)::bigint as saved
  from nodes n join steps s on s.conv_id = n.conv_id and s.d <= n.depth left join kids k on k.node = n.node
  group by s.node)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::bigint as n_children,
       b.n_leaves, b.saved as saved_tokens, sha256(n.ended) as ends_sha256
from nodes n join below b on n.node = b.node left join kids k on n.node = k.node left join nodes p on n.parent = p.node"""


@_query
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op11_suffix_dedup"] = """
with docs as (
  select doc_id, row_number() over () as rid, octet_length(encode(coalesce(text, ''))) as n, hex(encode(coalesce(text, ''))) as h from documents),
windows as (select rid, pos, md5(substring(h, 2 * pos + 1, 800)) as w from (select rid, h, unnest(range(n - 399)) as pos from docs where n >= 400)),
repeats as (select rid, pos from windows qualify count(*) over (partition by w) > 1),
placed as (select rid, pos, lag(pos) over (partition by rid order by pos) as before, lead(pos) over (partition by rid order by pos) as after from repeats),
pieces as (
  select p.rid, sum(least(400, coalesce(after - pos, 400))) as removed, count(*) filter (where before is null or pos - before > 400) as spans,
         string_agg(substring(h, 2 * coalesce(before + 400, 0) + 1, 2 * (pos - coalesce(before + 400, 0))), '' order by pos)
           filter (where before is null or pos - before > 400) || substring(min(h), 2 * (max(pos) + 400) + 1) as kept
  from placed p join docs d on p.rid = d.rid group by p.rid)
select doc_id, n::bigint as n_bytes, coalesce(removed, 0)::bigint as n_removed, coalesce(spans, 0)::bigint as n_spans,
       sha256(unhex(coalesce(kept, h))) as kept_sha256
from docs d left join pieces p on d.rid = p.rid"""
