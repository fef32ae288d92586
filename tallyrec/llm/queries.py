"""The queries of this subpackage and, where SQL can express one, the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.llm.bpe import encode_documents
from tallyrec.llm.codes import compress_vectors
from tallyrec.llm.html import extract_pages
from tallyrec.llm.language import language_predictions
from tallyrec.llm.mixing import mix_sources
from tallyrec.llm.negatives import hard_negatives
from tallyrec.llm.pivots import vector_duplicates
from tallyrec.llm.quality import quality_scores
from tallyrec.llm.quoting import link_quotations
from tallyrec.llm.search import top_products
from tallyrec.llm.sharding import assign_shards
from tallyrec.llm.simhash import simhash_duplicates
from tallyrec.llm.substrings import remove_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function under its name; without SQL it is tested against brute force."""

    def register(function: Callable) -> Callable:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(table(spark, sf_dir, "documents"))


VECTOR_DUPLICATES_SQL = """
with recursive usable as (
    select vec_id, label, cast(embedding as double[]) as v from embeddings
    where label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
    select a.vec_id as a, b.vec_id as b from usable a join usable b
    on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.v, b.v) >= 0.93
),
reached as (
    select vec_id, vec_id as other from embeddings
    union
    select reached.vec_id, links.b from reached join links on reached.other = links.a
),
least as (select vec_id, min(other) as component_id from reached group by vec_id)
select vec_id, (select count(*) from links where links.a = least.vec_id) as n_links, component_id,
       vec_id = component_id as kept
from least
"""


@query(VECTOR_DUPLICATES_SQL)
def op2_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_duplicates(table(spark, sf_dir, "embeddings"))


TOP_PRODUCTS_SQL = """
with usable as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select q.vec_id as query_id, r.vec_id, cast(list_inner_product(q.v, r.v) as bigint) as score
    from usable q join usable r on q.vec_id <> r.vec_id and len(q.v) = len(r.v)
    where q.vec_id % 20 = 0
)
select query_id, cast(rank as integer) as rank, vec_id, score from (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
    from scored)
where rank <= 20
"""


@query(TOP_PRODUCTS_SQL)
def op3_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_products(rows, rows.where("vec_id % 20 = 0"))


@query()
def op4_sampled_splitter_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


@query()
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, piece: n + piece["n_words"])
    mix = mix_sources(table(spark, sf_dir, "documents"))
    columns = ("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "pieces")
    return mix.select(*columns)


@query()
def op10_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    digests = ("n_tokens", "ids_sha256", "decoded_sha256")
    docs = table(spark, sf_dir, "documents")
    return encode_documents(docs, ranks, public_tokenizers.PATTERN, digests)


@query()
def op9_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_predictions(table(spark, sf_dir, "documents"))


@query()
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


QUOTATIONS_SQL = r"""
with recursive split as (
    select conv_id, turn, role, text,
           regexp_split_to_array(coalesce(text, ''), '\r\n|\r|\n') as parts
    from conversations
),
numbered as (
    select conv_id, turn, unnest(parts) as line, generate_subscripts(parts, 1) as i from split
),
levelled as (
    select conv_id, turn, i,
           length(replace(replace(regexp_extract(line, '^((?:[ \t]*>)+)', 1), ' ', ''), '\t', '')) as level,
           regexp_replace(line, '^(?:[ \t]*>)+[ \t]?', '') as content
    from numbered
),
announced as (
    select *, trim(content) = '' as empty,
           coalesce(lead(level) over message > level, false) and regexp_matches(content,
               '(?i)^(on|am|le|el)\s.*(wrote|schrieb.*|écrit|escribió)\s*:\s*$') as announces
    from levelled window message as (partition by conv_id, turn order by i)
),
runs as (
    select *, i - row_number() over (partition by conv_id, turn, level order by i) as run
    from announced where not empty and not announces
),
passages as (
    select conv_id, turn, level, run, list(content order by i) as own
    from runs group by conv_id, turn, level, run
),
said as (
    select conv_id, turn, level, run,
           unnest(list_distinct(list_transform(list_prepend(array_to_string(own, ' '), own),
               lambda s: lower(trim(regexp_replace(s, '\s+', ' ', 'g')))))) as unit
    from passages
),
units as (select * from said where unit <> ''),
originals as (
    select conv_id, unit, min(turn) as original from units where level = 0 group by conv_id, unit
),
linked as (
    select q.conv_id, q.turn, q.level, q.run, o.original
    from units q join originals o using (conv_id, unit) where q.level > 0 and o.original < q.turn
),
links as (
    select conv_id, turn, arg_max(original, (-level, original)) as reply_to,
           count(distinct (level, run)) as n_linked
    from linked group by conv_id, turn
),
threads as (
    select conv_id, turn, reply_to as thread, 1 as depth from links
    union all
    select t.conv_id, t.turn, l.reply_to, t.depth + 1
    from threads t join links l on l.conv_id = t.conv_id and l.turn = t.thread
),
roots as (
    select conv_id, turn, min(thread) as thread, max(depth) as depth from threads
    group by conv_id, turn
),
quotes as (
    select conv_id, turn, count(*) as n_quotes from passages where level > 0 group by conv_id, turn
),
own as (
    select conv_id, turn, max(level) as deepest,
           string_agg(content, chr(10) order by i) filter (where level = 0 and not announces) as text
    from announced group by conv_id, turn
)
select s.conv_id, s.turn, s.role,
       case when deepest > 0 then regexp_replace(coalesce(own.text, ''),
           '^(?:[ \t]*\n)+|(?:\n[ \t]*)+$', '', 'g') else s.text end as text,
       reply_to, coalesce(thread, s.turn) as thread, coalesce(depth, 0) as depth,
       coalesce(n_quotes, 0) as n_quotes, coalesce(n_linked, 0) as n_linked
from split s join own using (conv_id, turn) left join links using (conv_id, turn)
left join roots using (conv_id, turn) left join quotes using (conv_id, turn)
"""


@query(QUOTATIONS_SQL)
def op5_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotations(table(spark, sf_dir, "conversations"))


HARD_NEGATIVES_SQL = """
with usable as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
           cast(list_inner_product(a.v, b.v) as bigint) as score
    from usable a join usable b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where a.vec_id % 50 = 0
),
positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from (
        select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place
        from scored where same)
    where place <= 5
),
ranked as (
    select p.*, n.vec_id as negative_id, n.score as negative_score,
           row_number() over (partition by p.anchor_id, p.positive_id
                              order by n.score desc, n.vec_id) as rank
    from positives p join scored n using (anchor_id)
    where not n.same and 50 * positive_score <= 100 * n.score and 100 * n.score <= 95 * positive_score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score,
       negative_score
from ranked where rank <= 3
"""


@query(HARD_NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return hard_negatives(rows, rows.where("vec_id % 50 = 0"))


_CHOSEN = """
chosen{0} as (
    select n, p, min(struct_pack(d := a.c2 + b.c2 - 2 * list_inner_product(a.c, b.c), e := b.e)) as best
    from parts a join (select *, list_inner_product(c, c) as c2 from book{0}) b using (p)
    group by n, p
)"""
_REFINED = """
means{1} as (
    select p, e, list(m order by i) as c from (
        select p, best.e as e, i, floor(sum(c[i]) / count(*)) as m
        from chosen{0} join parts using (n, p), range(1, 5) place(i) group by p, best.e, i)
    group by p, e
),
book{1} as (
    select p, e, coalesce(means{1}.c, book{0}.c) as c from book{0} left join means{1} using (p, e)
)"""
VECTOR_CODES_SQL = f"""
with kept as (
    select *, row_number() over (order by vec_id) - 1 as n,
           list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
parts as materialized (
    select *, list_inner_product(c, c) as c2 from (
        select n, p, v[4 * p + 1 : 4 * p + 4] as c from kept, range(16) part(p))
),
book0 as (select p, n as e, c from parts where n < 64),
{_CHOSEN.format(0)}, {_REFINED.format(0, 1)},
{_CHOSEN.format(1)}, {_REFINED.format(1, 2)},
{_CHOSEN.format(2)},
coded as (
    select n, string_agg(printf('%02x', best.e), '' order by p) as code,
           cast(sum(best.d) as bigint) as error
    from chosen2 group by n
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(cast(cast(c[i] as bigint) as varchar), ',' order by p, e, i))
        from book2, range(1, 5) place(i)) as codebooks_sha256
from kept join coded using (n)
"""


@query(VECTOR_CODES_SQL)
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compress_vectors(table(spark, sf_dir, "embeddings")).codes
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@query()
def op13_passage_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
