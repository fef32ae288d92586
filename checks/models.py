"""Queries about the factor model, semantic search, fusion, metrics and batch answers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import views
from checks.registry import once_per_session, query, rounded, scratch
from checks.views import rounded as r
from checks.views import sql
from tallyrec.functions import columns as c
from tallyrec.operators import factor, fusion, metrics, semantic
from tallyrec.operators.nearest import top_matches
from tallyrec.plans import recommend as plans
from tallyrec.plans.recommend import HybridRecommender, SvdRecommender
from tallyrec.plans.serve import recommend_batch
from tallyrec.session import materialize
from tallyrec.sources import sinks

# --- parts of the factor model -------------------------------------------------------------

CELLS = """, cells as (
    select user_id, product_id, sum(cast(rating as double)) as value, count(*) as n
    from lines group by 1, 2),
items as (select count(distinct product_id) as n_items from cells),
offsets as (
    select user_id, sum(value) / any_value(n_items) as "offset" from cells, items group by user_id)
"""


def _cells(spark, sf_dir):
    return factor.rating_cells(views.lines(spark, sf_dir))


def _n_items(cells):
    return cells.select("product_id").distinct().count()


@query(
    sql("""
select product_id, row_number() over (order by substr(md5(product_id), 1, 3), product_id) - 1
       as item_idx
from (select distinct product_id from lines)""")
)
def item_index(spark, sf_dir):
    return factor.dense_index(views.lines(spark, sf_dir), "product_id", "item_idx")


@query(
    sql("""
select user_id, row_number() over (order by substr(md5(user_id), 1, 3), user_id) - 1 as user_idx
from (select distinct user_id from lines)""")
)
def user_index(spark, sf_dir):
    return factor.dense_index(views.lines(spark, sf_dir), "user_id", "user_idx")


@query(
    sql(
        CELLS
        + """
, user_ids as (
    select user_id, row_number() over (order by substr(md5(user_id), 1, 3), user_id) - 1 as user_idx
    from (select distinct user_id from lines)),
item_ids as (
    select product_id,
           row_number() over (order by substr(md5(product_id), 1, 3), product_id) - 1 as item_idx
    from (select distinct product_id from lines))
select user_idx, item_idx, value from cells join user_ids using (user_id)
join item_ids using (product_id)"""
    )
)
def indexed_cells(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    users = factor.dense_index(cells, "user_id", "user_idx")
    items = factor.dense_index(cells, "product_id", "item_idx")
    return (
        cells.join(users, "user_id").join(items, "product_id").select("user_idx", "item_idx", "value")
    )


@query(sql(CELLS + f' select user_id, {r('"offset"')} as user_offset from offsets'))
def user_offsets(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    offsets = factor.user_offsets(cells, _n_items(cells))
    return offsets.select("user_id", rounded("offset", alias="user_offset"))


@query(
    sql(
        CELLS
        + f"""
select user_id, product_id, {r('value - "offset"')} as centred from cells join offsets using (user_id)"""
    )
)
def centred_cells(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    centred = factor.centred_cells(cells, _n_items(cells))
    return centred.select("user_id", "product_id", rounded("centred"))


@query(
    sql(
        CELLS
        + f"""
select user_id, product_id,
       {r("case when max(value) over w > min(value) over w then (value - min(value) over w)"
          " / (max(value) over w - min(value) over w) else 0 end")} as score
from cells window w as (partition by user_id)"""
    )
)
def scaled_scores(spark, sf_dir):
    whole = Window.partitionBy("user_id")
    scored = c.unit_scale(
        F.col("value"), F.min("value").over(whole), F.max("value").over(whole)
    )
    return _cells(spark, sf_dir).select("user_id", "product_id", c.round_half_up(scored, 6).alias("score"))


POPULAR = """, popular as (
    select product_id, count(*) as n,
           cast(row_number() over (order by count(*) desc, product_id) as int) as "rank"
    from lines group by product_id)"""


@query(sql(POPULAR + ' select product_id, n from popular where "rank" <= 100'))
def popular_items(spark, sf_dir):
    return plans.popular_items(plans.popularity(_cells(spark, sf_dir)), 100)


@query(
    sql(
        POPULAR
        + """
select user_id, product_id, cast(0 as double) as score, "rank"
from (select distinct 'visitor-' || user_id as user_id from reviews where user_id is not null), popular
where "rank" <= 10"""
    )
)
def popular_for_unknown_users(spark, sf_dir):
    visitors = views.reviews(spark, sf_dir).where("user_id is not null")
    visitors = visitors.select(F.concat(F.lit("visitor-"), "user_id").alias("user_id")).distinct()
    counts = plans.popularity(_cells(spark, sf_dir))
    return plans.popular_lists(counts, visitors.withColumn("depth", F.lit(10)), 10)


@query(
    sql(
        POPULAR
        + """
select user_id, product_id, cast(0 as double) as score, "rank"
from (select unnest([null, 'a', 'b']) as user_id), popular
where "rank" <= case user_id when 'a' then 3 else 2000000 end"""
    )
)
def popular_for_deep_requests(spark, sf_dir):
    # deeper than the catalogue, and for a missing id
    users = spark.sql("select * from values (null, 2000000), ('a', 3), ('b', 2000000) as t(user_id, depth)")
    return plans.popular_lists(plans.popularity(_cells(spark, sf_dir)), users, 2_000_000)


# --- the factor model ----------------------------------------------------------------------


def brand_ratings(spark, sf_dir):
    """Ratings of brands, one of them listed twice under different ids.

    The copy makes the matrix one rank short, so the model, which keeps one factor fewer than
    there are products, reproduces the matrix exactly and SQL can state every score.
    """
    lines = views.lines(spark, sf_dir).select("user_id", "product_id", "rating")
    part = views.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), "p_brand"
    )
    brands = lines.join(part, "product_id").select("user_id", "rating", F.col("p_brand").alias("product_id"))
    copies = brands.where("product_id = 'Brand#1'").withColumn("product_id", F.lit("Brand#1 copy"))
    return brands.union(copies)


BRAND_CELLS = """, brand_lines as (
    select user_id, p_brand as product_id, cast(rating as double) as rating
    from lines join part on product_id = cast(p_partkey as varchar)),
brand_ratings as (
    select * from brand_lines union all
    select user_id, 'Brand#1 copy', rating from brand_lines where product_id = 'Brand#1'),
brand_cells as (
    select user_id, product_id, sum(rating) as value from brand_ratings group by 1, 2),
brands as (select distinct product_id from brand_ratings),
brand_offsets as (
    select user_id, sum(value) / (select count(*) from brands) as mean from brand_cells group by 1),
predicted as (
    select o.user_id, b.product_id, coalesce(value - mean, 0) + mean as score
    from brand_offsets o cross join brands b
    left join brand_cells c on c.user_id = o.user_id and c.product_id = b.product_id)"""


# Scores are compared in steps of 1e-5. The steps do not begin at a half, where many of these
# fractions lie and the last bit would decide.
STEPS, STEP_START = 1e5, 0.37


@query(
    sql(
        BRAND_CELLS
        + f"""
select user_id, product_id,
       cast(floor((score - min(score) over w) / (max(score) over w - min(score) over w)
                  * {STEPS} + {STEP_START}) as bigint) as score_steps
from predicted window w as (partition by user_id)"""
    )
)
def svd_reproduces_matrix(spark, sf_dir):
    ratings = brand_ratings(spark, sf_dir)
    model = SvdRecommender().fit(ratings)
    users = ratings.select("user_id").distinct()
    steps = F.floor(F.col("score") * STEPS + STEP_START).alias("score_steps")
    return model.recommend(users, 100).select("user_id", "product_id", steps)


@once_per_session
def _ratings(spark, sf_dir):
    """The interactions as a written table, which the models are trained and judged on."""
    return materialize(views.interactions(spark, sf_dir), "interactions")


@once_per_session
def svd_model(spark, sf_dir) -> SvdRecommender:
    return SvdRecommender().fit(_ratings(spark, sf_dir))


def hybrid_model(spark, sf_dir, **settings) -> HybridRecommender:
    return HybridRecommender.build(
        svd_model(spark, sf_dir), views.vectors(spark, sf_dir), ["product_id"], **settings
    )


def _all_users(spark, sf_dir):
    return _ratings(spark, sf_dir).select("user_id").distinct()


@query()
def svd_recommendations(spark, sf_dir):
    return svd_model(spark, sf_dir).recommend(_all_users(spark, sf_dir))


@query()
def svd_evaluation(spark, sf_dir):
    return svd_model(spark, sf_dir).evaluate(_ratings(spark, sf_dir))


@query()
def svd_saved_model(spark, sf_dir):
    path = scratch(spark, "svd")
    svd_model(spark, sf_dir).save(path)
    return SvdRecommender.load(spark, path).recommend(_all_users(spark, sf_dir))


# --- semantic search -----------------------------------------------------------------------


@query(
    sql("""
select product_id,
       case when title is null and description is null then product_id
            else concat_ws(' | ', title, description) end as "text"
from products""")
)
def product_texts(spark, sf_dir):
    return semantic.product_texts(views.products(spark, sf_dir))


def _elements(embedded, digits):
    """One row per element of each vector."""
    each = embedded.select("product_id", F.posexplode("embedding").alias("position", "x"))
    return each.select("product_id", "position", c.round_half_up(F.col("x").cast("double"), digits).alias("x"))


def _shape(embedded):
    length = F.sqrt(c.dot(F.col("embedding"), F.col("embedding")))
    return embedded.select(
        "product_id", F.size("embedding").alias("dim"), c.round_half_up(length, 4).alias("length")
    )


@query(sql('select product_id, 384 as dim, 1.0::double as "length" from products'))
def embed_products(spark, sf_dir):
    return _shape(semantic.embed_products(views.products(spark, sf_dir)))


@query("select cast(doc_id as varchar) as product_id, 384 as dim, 1.0::double as length from documents")
def embed_documents(spark, sf_dir):
    texts = views.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("product_id"), "text")
    return _shape(semantic.embed_texts(texts))


LETTERS = "abcdefghijklmnopqrstuvwxy"


@query(
    f"""
with counts as (
    select cast(doc_id as varchar) as product_id, list_prepend(1, list_transform(
               string_split('{" ".join(LETTERS)}', ' '),
               lambda c: len(lower("text")) - len(replace(lower("text"), c, '')))) as n
    from documents),
elements as (
    select product_id, unnest(n) as x, generate_subscripts(n, 1) - 1 as position,
           sqrt(list_sum(list_transform(n, lambda c: c * c))) as length
    from counts)
select product_id, cast(position as int) as position, {r("x / length", 4)} as x from elements"""
)
def embed_with_own_encoder(spark, sf_dir):
    def load_encoder():
        letters = LETTERS

        def encode(texts):
            return [[1.0, *(text.lower().count(letter) for letter in letters)] for text in texts]

        return encode

    texts = views.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("product_id"), "text")
    return _elements(semantic.embed_texts(texts, load_encoder), 4)


@query(
    sql(f"""
, scaled as (
    select product_id, list_transform(embedding, lambda x: x * (len(product_id) + 1)) as v
    from vectors)
select product_id, {r("sqrt(list_inner_product(v, v))", 4)} as before,
       1.0::double as after, {r("v[1] / sqrt(list_inner_product(v, v))", 5)} as first
from scaled""")
)
def l2_normalize(spark, sf_dir):
    longer = views.vectors(spark, sf_dir).select(
        "product_id",
        F.transform(
            "embedding", lambda x: x.cast("double") * (F.length("product_id") + 1)
        ).alias("v"),
    )
    unit = c.l2_normalize(F.col("v"))
    return longer.select(
        "product_id",
        c.round_half_up(F.sqrt(c.dot(F.col("v"), F.col("v"))), 4).alias("before"),
        c.round_half_up(F.sqrt(c.dot(unit, unit)), 4).alias("after"),
        c.round_half_up(unit[0], 5).alias("first"),
    )


@query(
    sql(f"""
select product_id, cast(position as int) as position, {r("x", 6)} as x from (
    select product_id, unnest(embedding) as x, generate_subscripts(embedding, 1) - 1 as position
    from vectors)""")
)
def vector_table(spark, sf_dir):
    path = scratch(spark, "vectors")
    sinks.save_vectors(views.vectors(spark, sf_dir), path)
    return _elements(sinks.load_vectors(spark, path), 6)


@query(sql("select product_id, floor(embedding[1] * 1e6 + 0.5) / 1e6 as first from vectors"))
def unique_vectors(spark, sf_dir):
    vectors = views.vectors(spark, sf_dir).withColumn("position", F.lit(1))
    later = vectors.select(
        "product_id", F.reverse("embedding").alias("embedding"), F.lit(2).alias("position")
    )
    kept = semantic.unique_vectors(later.union(vectors), ["position"])
    return kept.select("product_id", c.round_half_up(F.col("embedding")[0].cast("double"), 6).alias("first"))


def matches_sql(queries: str, top_k: int, exclude: bool) -> str:
    """The best products by inner product, compared at nine digits, ties by id."""
    condition = "where q.query_id <> v.product_id" if exclude else ""
    return f"""
    select query_id, product_id, score, cast(row_number() over (
               partition by query_id order by score desc, product_id) as int) as "rank"
    from (select q.query_id, v.product_id,
                 {r("list_inner_product(q.vector, v.embedding)", 9)} as score
          from ({queries}) q cross join vectors v {condition})
    qualify "rank" <= {top_k}"""


SIMILAR = matches_sql("select product_id as query_id, embedding as vector from vectors", 10, True)
REVERSED = matches_sql(
    "select 'q' || product_id as query_id, list_reverse(embedding) as vector from vectors", 10, False
)


@query(sql(SIMILAR))
def similar_products(spark, sf_dir):
    index = semantic.SemanticIndex(views.vectors(spark, sf_dir))
    # most products of the catalogue have no vector: those give no rows
    wanted = views.products(spark, sf_dir).unionByName(
        views.vectors(spark, sf_dir), allowMissingColumns=True
    )
    return index.similar_products(wanted.select("product_id").distinct(), 10)


@query(sql(REVERSED))
def similar_to_vector(spark, sf_dir):
    vectors = views.vectors(spark, sf_dir)
    queries = vectors.select(
        F.concat(F.lit("q"), "product_id").alias("query_id"), F.reverse("embedding").alias("embedding")
    )
    return semantic.SemanticIndex(vectors).similar_to_vector(queries, 10)


@query(sql(SIMILAR))
def similar_products_in_blocks(spark, sf_dir):
    vectors = views.vectors(spark, sf_dir)
    queries = vectors.select(
        F.col("product_id").alias("query_id"), F.col("embedding").alias("vector"), F.lit(10).alias("depth")
    )
    index = vectors.select("product_id", F.col("embedding").alias("vector"))
    found = top_matches(queries, index, exclude_self=True, block_bytes=64 << 10)
    return found.select("query_id", "product_id", "score", "rank")


GAPS = """, gaps as (
    select product_id, case when cast(product_id as int) % 9 = 0 then null
        else list_transform(embedding, lambda x, i: case
            when cast(product_id as int) % 7 = 0 then 0
            when cast(product_id as int) % 11 = 0 and i = 2 then null
            when cast(product_id as int) % 13 = 0 and i = 3 then 'nan'::double
            else x end) end as embedding
    from vectors),
usable as (
    select product_id, list_transform(embedding, lambda x: coalesce(x, 0)) as embedding
    from gaps where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x))) = 0)"""
SIMILAR_WITH_GAPS = GAPS + matches_sql(
    "select product_id as query_id, embedding as vector from usable", 10, True
).replace("cross join vectors v", "cross join usable v")


def _with_gaps(spark, sf_dir):
    """Some vectors are null or zero, or hold a null or NaN."""
    number = F.col("product_id").cast("int")
    changed = F.transform(
        F.col("embedding").cast("array<double>"),
        lambda x, i: F.when(number % 7 == 0, 0.0)
        .when((number % 11 == 0) & (i == 1), F.lit(None))
        .when((number % 13 == 0) & (i == 2), F.lit(float("nan")))
        .otherwise(x),
    )
    vector = F.when(number % 9 != 0, changed)
    return views.vectors(spark, sf_dir).select("product_id", vector.alias("embedding"))


@query(sql(SIMILAR_WITH_GAPS))
def similar_products_with_gaps(spark, sf_dir):
    vectors = _with_gaps(spark, sf_dir)
    return semantic.SemanticIndex(vectors).similar_products(vectors.select("product_id"), 10)


@query(sql(SIMILAR_WITH_GAPS))
def similar_products_with_gaps_in_blocks(spark, sf_dir):
    index = _with_gaps(spark, sf_dir).withColumnRenamed("embedding", "vector")
    queries = index.select(F.col("product_id").alias("query_id"), "vector", F.lit(10).alias("depth"))
    found = top_matches(queries, index, exclude_self=True, block_bytes=16 << 10)
    return found.select("query_id", "product_id", "score", "rank")


# --- fusion --------------------------------------------------------------------------------

# Given candidates: a user's own products by rating sum, scaled per user, and the products similar
# to the first of them.
CANDIDATES = (
    CELLS
    + f"""
, cf as (
    select user_id, product_id, "rank",
           case when high > low then {r("(value - low) / (high - low)", 9)} else 0 end as score
    from (select user_id, product_id, value, min(value) over (partition by user_id) as low,
                 max(value) over (partition by user_id) as high,
                 cast(row_number() over (partition by user_id order by value desc, product_id) as int)
                   as "rank"
          from cells)
    where "rank" <= 30),
seeds as (select user_id, product_id as seed from cf where "rank" = 1),
found as ({matches_sql('''select product_id as query_id, embedding as vector from vectors
                          where product_id in (select seed from seeds)''', 30, True)}),
semantic as (
    select user_id, product_id, score, "rank" from seeds join found on query_id = seed)"""
)


def _candidates(spark, sf_dir):
    whole = Window.partitionBy("user_id")
    order = whole.orderBy(F.col("value").desc(), "product_id")
    scaled = c.unit_scale(F.col("value"), F.min("value").over(whole), F.max("value").over(whole))
    cf = (
        _cells(spark, sf_dir)
        .withColumn("score", c.round_half_up(scaled, 9))
        .withColumn("rank", F.row_number().over(order))
        .where("rank <= 30")
        .select("user_id", "product_id", "score", "rank")
    )
    seeds = cf.where("rank = 1").select("user_id", F.col("product_id").alias("seed"))
    index = semantic.SemanticIndex(views.vectors(spark, sf_dir))
    found = index.similar_products(seeds.select(F.col("seed").alias("product_id")), 30)
    similar = seeds.join(found.withColumnRenamed("query_id", "seed"), "seed").drop("seed")
    return cf, similar


def fused_sql(cf_part: str, semantic_part: str, digits: int, by: str = "user_id") -> str:
    return f"""
, parts as (
    select {by}, product_id, {cf_part} as part, "rank" as cf_rank, null as semantic_rank from cf
    union all
    select {by}, product_id, {semantic_part}, null, "rank" from semantic),
fused as (
    select {by}, product_id, sum(part) as score, min(cf_rank) as cf_rank,
           min(semantic_rank) as semantic_rank
    from parts group by {by}, product_id),
ranked as (
    select {by}, product_id, {r("score", digits)} as score, cast(row_number() over (
               partition by {by}
               order by score desc, cf_rank asc nulls last, semantic_rank asc) as int) as "rank"
    from fused qualify "rank" <= 10)"""


RANKED = 'select user_id, product_id, score, "rank" from ranked'
WEIGHTED_SQL = fused_sql("0.6::double * score", "(1 - 0.6::double) * score", 4)
RECIPROCAL_SQL = fused_sql('1.0::double / ("rank" + 60)', '1.0::double / ("rank" + 60)', 6)


@query(sql(CANDIDATES + 'select user_id, product_id, score, "rank" from cf'))
def candidates_cf(spark, sf_dir):
    return _candidates(spark, sf_dir)[0]


@query(sql(CANDIDATES + 'select user_id, product_id, score, "rank" from semantic'))
def candidates_semantic(spark, sf_dir):
    return _candidates(spark, sf_dir)[1]


@query(sql(CANDIDATES + WEIGHTED_SQL + RANKED))
def weighted_fusion(spark, sf_dir):
    return fusion.weighted_fusion(*_candidates(spark, sf_dir), 10)


@query(sql(CANDIDATES + RECIPROCAL_SQL + RANKED))
def rank_fusion(spark, sf_dir):
    return fusion.rank_fusion(*_candidates(spark, sf_dir), 10)


TUNING = (
    CANDIDATES.replace("cf as (", "all_cf as (")
    .replace("from cf where", "from all_cf where")
    .replace("semantic as (", "all_semantic as (")
    + """
, grid as (
    select unnest([0, 1, 2, 3, 4, 5]) as position,
           unnest([0.3, 0.4, 0.5, 0.6, 0.7, 0.8]::double[]) as alpha),
relevant as (select distinct user_id, product_id from interactions where rating >= 4),
judges as (select distinct user_id from relevant),
cf as (select * from all_cf cross join grid),
semantic as (select * from all_semantic cross join grid)"""
    + fused_sql(
        "alpha * score", "(1 - alpha) * score", 4, "user_id, position, alpha"
    )
    + """
, gains as (
    select position, alpha, user_id, sum(1 / log2("rank" + 1)) as gain
    from ranked join relevant using (user_id, product_id) group by 1, 2, 3),
ideals as (
    select user_id, list_sum(list_transform(range(1, least(count(*), 10) + 1),
                                            lambda i: 1 / log2(i + 1))) as ideal
    from relevant group by user_id),
scores as (
    select position, alpha, avg(coalesce(gain, 0) / ideal) as ndcg
    from judges cross join grid join ideals using (user_id)
    left join gains using (position, alpha, user_id) group by 1, 2)"""
)


def _alpha_scores(spark, sf_dir):
    ratings = _ratings(spark, sf_dir)
    cf, similar = _candidates(spark, sf_dir)
    return fusion.alpha_scores(
        cf, similar, metrics.relevant_products(ratings), fusion.tuning_users(ratings)
    )


@query(sql(TUNING + f"select position, alpha, {r('ndcg')} as ndcg from scores"))
def alpha_scores(spark, sf_dir):
    return _alpha_scores(spark, sf_dir).select("position", "alpha", rounded("ndcg"))


@query(
    sql(TUNING + f"select alpha, {r('ndcg')} as ndcg from scores order by round(scores.ndcg, 12) desc, position limit 1")
)
def best_alpha(spark, sf_dir):
    best = fusion.best_alpha(_alpha_scores(spark, sf_dir))
    return best.select("alpha", rounded("ndcg"))


@query(
    sql("""
select distinct user_id from interactions where rating >= 4""")
)
def tuning_users(spark, sf_dir):
    return fusion.tuning_users(views.interactions(spark, sf_dir))


# --- metrics -------------------------------------------------------------------------------

# Given recommendations: the latest products of each user.
LATEST = """, recommended as (
    select user_id, product_id,
           cast(row_number() over (partition by user_id order by "timestamp" desc, product_id) as int)
             as "rank"
    from interactions qualify "rank" <= 20),
relevant as (select distinct user_id, product_id from interactions where rating >= 4),
hits as (
    select r.*, (v.user_id is not null)::int as hit
    from recommended r left join relevant v using (user_id, product_id)),
found as (
    select user_id, sum(hit) filter ("rank" <= 10) as n_hits,
           sum(hit / log2("rank" + 1)) filter ("rank" <= 10) as gain, max(hit / "rank") as mrr
    from hits group by user_id),
per_user as (
    select user_id, coalesce(n_hits, 0) / 10.0 as "precision", coalesce(n_hits, 0) / n as recall,
           coalesce(gain, 0) / ideal as ndcg, coalesce(mrr, 0) as mrr
    from (select user_id, count(*) as n,
                 list_sum(list_transform(range(1, least(count(*), 10) + 1),
                                         lambda i: 1 / log2(i + 1))) as ideal
          from relevant group by user_id) left join found using (user_id))"""
METRICS = ("precision", "recall", "ndcg", "mrr")


def quoted(name: str) -> str:
    return f'"{name}"'


def _latest(spark, sf_dir):
    ratings = _ratings(spark, sf_dir)
    order = Window.partitionBy("user_id").orderBy(F.col("timestamp").desc(), "product_id")
    latest = ratings.withColumn("rank", F.row_number().over(order)).where("rank <= 20")
    return latest.select("user_id", "product_id", "rank"), metrics.relevant_products(ratings)


@query(sql(LATEST + 'select user_id, product_id, "rank", hit from hits'))
def recommendation_hits(spark, sf_dir):
    return metrics.hits(*_latest(spark, sf_dir))


@query(
    sql(LATEST + f"""select user_id, {', '.join(f'{r(quoted(m))} as "{m}"' for m in METRICS)} from per_user""")
)
def user_metrics(spark, sf_dir):
    return metrics.user_metrics(*_latest(spark, sf_dir)).select("user_id", *map(rounded, METRICS))


MEANS = {"precision": "precision_at_10", "recall": "recall_at_10", "ndcg": "ndcg_at_10", "mrr": "mrr"}


@query(
    sql(
        LATEST
        + "select "
        + ", ".join(f"""{r(f'avg("{m}")')} as {name}""" for m, name in MEANS.items())
        + " from per_user"
    )
)
def mean_metrics(spark, sf_dir):
    means = metrics.mean_metrics(metrics.user_metrics(*_latest(spark, sf_dir)))
    return means.select(*map(rounded, MEANS.values()))


@query(
    sql("""
select user_id, count(distinct product_id) as n, min(product_id) as first, max(product_id) as last
from interactions where rating >= 4 group by user_id""")
)
def relevant_lists(spark, sf_dir):
    lists = metrics.relevant_lists(views.interactions(spark, sf_dir))
    return lists.select(
        "user_id",
        F.size("products").cast("bigint").alias("n"),
        F.col("products")[0].alias("first"),
        F.try_element_at("products", F.lit(-1)).alias("last"),
    )


# --- hybrid model and batch answers --------------------------------------------------------


@query()
def hybrid_recommendations(spark, sf_dir):
    return hybrid_model(spark, sf_dir).recommend(_all_users(spark, sf_dir))


@query()
def hybrid_rank_fusion(spark, sf_dir):
    model = hybrid_model(spark, sf_dir, strategy="rank_fusion")
    return model.recommend(_all_users(spark, sf_dir))


@query()
def hybrid_tuning(spark, sf_dir):
    return hybrid_model(spark, sf_dir).tuning_scores(_ratings(spark, sf_dir))


@query()
def hybrid_saved_model(spark, sf_dir):
    path = scratch(spark, "hybrid")
    hybrid_model(spark, sf_dir, alpha=0.7, version="1.1.0").save(path)
    model = HybridRecommender.load(spark, path)
    found = model.recommend(_all_users(spark, sf_dir))
    return found.withColumn("model_version", F.lit(model.version))


@query()
def batch_responses(spark, sf_dir):
    requests = materialize(views.requests(spark, sf_dir), "requests")
    return recommend_batch(hybrid_model(spark, sf_dir), requests)
