"""The models' public surface against SQL.

The models are trained on ratings of brands. One brand is listed twice, so the matrix is one rank
short and a truncation to one factor fewer than columns reproduces it: SQL can state every score,
and from there every list, fusion, metric and response.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import views
from checks.models import BRAND_CELLS, MEANS, brand_ratings, matches_sql, quoted
from checks.registry import once_per_session, query, rounded, scratch
from checks.views import rounded as r
from checks.views import sql
from tallyrec.operators.fusion import ALPHA_GRID
from tallyrec.plans.recommend import HybridRecommender, SvdRecommender
from tallyrec.plans.serve import recommend_batch
from tallyrec.session import materialize

# Every list of the collaborative model, and the vectors of most brands: sums of whole numbers over
# all embeddings, dealt to those brands in turn, so that the order of addition does not matter.
LISTS = (
    BRAND_CELLS
    + f"""
, scored as (select user_id, product_id, {r("score", 9)} as score from predicted),
known as (
    select user_id, product_id,
           case when max(score) over w > min(score) over w
                then (score - min(score) over w) / (max(score) over w - min(score) over w)
                else 0 end as score,
           cast(row_number() over (partition by user_id order by score desc, product_id) as int)
             as "rank"
    from scored window w as (partition by user_id)),
popular as (
    select product_id,
           cast(row_number() over (order by count(*) desc, product_id) as int) as "rank"
    from brand_ratings group by product_id),
visitors as (
    select distinct user_id from (
        select user_id from requests union all select 'visitor' union all select null)
    where user_id is null or user_id not in (select user_id from brand_cells)),
all_cf as (
    select user_id, product_id, score, "rank" from known union all
    select user_id, product_id, 0::double, "rank" from visitors, popular),
brand_turns as (
    select product_id, row_number() over (order by n) - 1 as turn, count(*) over () as n_turns
    from (select product_id, row_number() over (order by product_id) as n from brands)
    where n % 7 <> 0),
brand_sums as (
    select b.product_id, place, sum(cast(floor(embedding[place] * 1048576) as bigint))::double as total
    from (select product_id, embedding, unnest(range(1, len(embedding) + 1)) as place from vectors) v
    join brand_turns b on cast(v.product_id as bigint) % n_turns = turn
    group by 1, 2),
brand_vectors as (
    select product_id, list(total / norm order by place) as embedding
    from (select *, sqrt(sum(total * total) over (partition by product_id)) as norm from brand_sums)
    group by product_id),
seeds as (select user_id, product_id as seed from all_cf where "rank" = 1),
alike as ({matches_sql('''select product_id as query_id, embedding as vector from brand_vectors
    where product_id in (select seed from seeds)''', 300, True).replace(
        "cross join vectors v", "cross join brand_vectors v")}),
all_semantic as (
    select user_id, product_id, score, "rank" from seeds join alike on query_id = seed)"""
)


def fused(by: str, cf_part: str, semantic_part: str, digits: int, depth: str) -> str:
    """Views cf and semantic, by list, as the view ``ranked``."""
    return f"""
, parts as (
    select {by}, product_id, {cf_part} as part, "rank" as cf_rank, null as semantic_rank from cf
    union all
    select {by}, product_id, {semantic_part}, null, "rank" from semantic),
sums as (
    select {by}, product_id, sum(part) as score, min(cf_rank) as cf_rank,
           min(semantic_rank) as semantic_rank
    from parts group by {by}, product_id),
ranked as (
    select {by}, product_id, {r("score", digits)} as score, cast(row_number() over (
               partition by {by}
               order by score desc, cf_rank asc nulls last, semantic_rank asc) as int) as "rank"
    from sums qualify "rank" <= {depth})"""


PLAIN = """, cf as (select * from all_cf where "rank" <= 30),
semantic as (select * from all_semantic where "rank" <= 30)"""
WEIGHTED = fused("user_id", "{a}::double * score", "(1 - {a}::double) * score", 4, "10")
BY_RANK = fused("user_id", '1.0::double / ("rank" + 60)', '1.0::double / ("rank" + 60)', 6, "10")
OUT = f' select user_id, product_id, {r("score")} as score, "rank" from '


def judged(recommended: str) -> str:
    """The view ``per_user``: four metrics of each user with a relevant brand."""
    return f""", relevant as (
    select distinct user_id, product_id from brand_ratings where rating >= 4),
found as (
    select user_id, sum(hit) filter ("rank" <= 10) as n_hits,
           sum(hit / log2("rank" + 1)) filter ("rank" <= 10) as gain, max(hit / "rank") as mrr
    from (select l.*, (v.user_id is not null)::int as hit
          from ({recommended}) l left join relevant v using (user_id, product_id))
    group by user_id),
per_user as (
    select user_id, coalesce(n_hits, 0) / 10.0 as "precision", coalesce(n_hits, 0) / n as recall,
           coalesce(gain, 0) / ideal as ndcg, coalesce(mrr, 0) as mrr
    from (select user_id, count(*) as n,
                 list_sum(list_transform(range(1, least(count(*), 10) + 1),
                                         lambda i: 1 / log2(i + 1))) as ideal
          from relevant group by user_id) left join found using (user_id))"""


MEANS_SQL = (
    " select " + ", ".join(f"""{r(f'avg({quoted(m)})')} as {name}""" for m, name in MEANS.items())
    + " from per_user"
)


@once_per_session
def _ratings(spark, sf_dir) -> DataFrame:
    return materialize(brand_ratings(spark, sf_dir), "brand-ratings")


@once_per_session
def _svd(spark, sf_dir) -> SvdRecommender:
    return SvdRecommender().fit(_ratings(spark, sf_dir))


@once_per_session
def _vectors(spark, sf_dir) -> DataFrame:
    brands = _ratings(spark, sf_dir).select("product_id").distinct().orderBy("product_id")
    names = [row.product_id for row in brands.collect()]  # some 25
    kept = [name for n, name in enumerate(names, 1) if n % 7]
    turns = spark.createDataFrame(list(zip(kept, range(len(kept)))), "brand string, turn int")
    parts = views.vectors(spark, sf_dir).select(
        (F.col("product_id").cast("long") % len(kept)).alias("turn"),
        F.posexplode("embedding").alias("at", "x"),
    )
    whole = F.floor(F.col("x").cast("double") * 1048576)
    sums = parts.groupBy("turn", "at").agg(F.sum(whole).cast("double").alias("total"))
    # one row per brand and component is left: some 25 short arrays
    own = sums.groupBy("turn").agg(F.sort_array(F.collect_list(F.struct("at", "total"))).alias("own"))
    totals = F.col("own.total")
    norm = F.sqrt(F.aggregate(totals, F.lit(0.0), lambda n, x: n + x * x))
    unit = own.select("turn", F.transform(totals, lambda x: x / norm).alias("embedding"))
    first = unit.join(turns, "turn").select(
        F.col("brand").alias("product_id"), "embedding", F.lit(1).alias("place")
    )
    # a second vector per brand that must not count
    second = first.select("product_id", F.reverse("embedding").alias("embedding"), F.lit(2).alias("place"))
    return materialize(second.union(first), "brand-vectors")


def _hybrid(spark, sf_dir, **settings) -> HybridRecommender:
    return HybridRecommender.build(
        _svd(spark, sf_dir), _vectors(spark, sf_dir), ["place"], **settings
    )


def _users(spark, sf_dir) -> DataFrame:
    """All users of the requests, one unknown user, and a missing id."""
    asked = views.requests(spark, sf_dir).select("user_id")
    known = _ratings(spark, sf_dir).select("user_id")
    others = spark.sql("select * from values ('visitor'), (cast(null as string)) as t(user_id)")
    return asked.union(known).union(others).distinct()


def _lists(found: DataFrame) -> DataFrame:
    return found.select("user_id", "product_id", rounded("score"), "rank")


@query(sql(LISTS + OUT + 'all_cf where "rank" <= 10'))
def brand_svd_recommendations(spark, sf_dir):
    return _lists(_svd(spark, sf_dir).recommend(_users(spark, sf_dir)))


@query(sql(LISTS + judged('select * from all_cf where "rank" <= 10') + MEANS_SQL))
def brand_svd_evaluation(spark, sf_dir):
    found = _svd(spark, sf_dir).evaluate(_ratings(spark, sf_dir))
    return found.select(*map(rounded, MEANS.values()))


@query(sql(LISTS + OUT + 'all_cf where "rank" <= 10'))
def brand_svd_saved_model(spark, sf_dir):
    path = scratch(spark, "brand-svd")
    _svd(spark, sf_dir).save(path)
    return _lists(SvdRecommender.load(spark, path).recommend(_users(spark, sf_dir)))


@query(sql(LISTS + PLAIN + WEIGHTED.format(a=0.6) + OUT + "ranked"))
def brand_hybrid_recommendations(spark, sf_dir):
    return _lists(_hybrid(spark, sf_dir).recommend(_users(spark, sf_dir)))


@query(sql(LISTS + PLAIN + BY_RANK + OUT + "ranked"))
def brand_hybrid_rank_fusion(spark, sf_dir):
    model = _hybrid(spark, sf_dir, strategy="rank_fusion")
    return _lists(model.recommend(_users(spark, sf_dir)))


@query(sql(LISTS + PLAIN + WEIGHTED.format(a=0.7) + judged("select * from ranked") + MEANS_SQL))
def brand_hybrid_evaluation(spark, sf_dir):
    found = _hybrid(spark, sf_dir, alpha=0.7).evaluate(_ratings(spark, sf_dir))
    return found.select(*map(rounded, MEANS.values()))


@query(sql(LISTS + PLAIN + WEIGHTED.format(a=0.7) + OUT.replace("from", ", '1.1.0' as model_version from") + "ranked"))
def brand_hybrid_saved_model(spark, sf_dir):
    path = scratch(spark, "brand-hybrid")
    _hybrid(spark, sf_dir, alpha=0.7, version="1.1.0").save(path)
    model = HybridRecommender.load(spark, path)
    found = _lists(model.recommend(_users(spark, sf_dir)))
    return found.withColumn("model_version", F.lit(model.version))


# A model that is saved, loaded, saved again in its place with another weight, and loaded.
@query(sql(LISTS + PLAIN + WEIGHTED.format(a=0.3) + OUT + "ranked"))
def brand_hybrid_saved_in_place(spark, sf_dir):
    path = scratch(spark, "brand-hybrid-in-place")
    _hybrid(spark, sf_dir, alpha=0.7).save(path)
    model = HybridRecommender.load(spark, path)
    model.alpha = 0.3
    model.save(path)
    return _lists(HybridRecommender.load(spark, path).recommend(_users(spark, sf_dir)))


@query(sql(LISTS + OUT + 'all_cf where "rank" <= 10'))
def brand_svd_saved_in_place(spark, sf_dir):
    path = scratch(spark, "brand-svd-in-place")
    _svd(spark, sf_dir).save(path)
    SvdRecommender.load(spark, path).save(path)
    return _lists(SvdRecommender.load(spark, path).recommend(_users(spark, sf_dir)))


GRID = f""", grid as (
    select unnest({list(range(len(ALPHA_GRID)))}) as position, unnest({list(ALPHA_GRID)}::double[]) as alpha),
cf as (select * from all_cf cross join grid where "rank" <= 30),
semantic as (select * from all_semantic cross join grid where "rank" <= 30)"""


@query(
    sql(
        LISTS
        + GRID
        + fused("user_id, position, alpha", "alpha * score", "(1 - alpha) * score", 4, "10")
        + """, relevant as (
    select distinct user_id, product_id from brand_ratings where rating >= 4),
gains as (
    select position, user_id, sum(1 / log2("rank" + 1)) as gain
    from ranked join relevant using (user_id, product_id) group by 1, 2),
ideals as (
    select user_id, list_sum(list_transform(range(1, least(count(*), 10) + 1),
                                            lambda i: 1 / log2(i + 1))) as ideal
    from relevant group by user_id)"""
        + f"""
select position, alpha, {r("avg(coalesce(gain, 0) / ideal)")} as ndcg
from ideals cross join grid left join gains using (position, user_id) group by 1, 2"""
    )
)
def brand_hybrid_tuning(spark, sf_dir):
    scores = _hybrid(spark, sf_dir).tuning_scores(_ratings(spark, sf_dir))
    return scores.select("position", "alpha", rounded("ndcg"))


@query(
    sql(
        LISTS
        + """, asked as (
    select distinct user_id, top_k from requests where top_k between 1 and 100),
cf as (select asked.top_k, c.* from asked join all_cf c using (user_id) where "rank" <= 3 * top_k),
semantic as (
    select asked.top_k, s.* from asked join all_semantic s using (user_id) where "rank" <= 3 * top_k)"""
        + fused("user_id, top_k", "0.6::double * score", "(1 - 0.6::double) * score", 4, "top_k")
        + f"""
select request_id, q.user_id, q.top_k,
       case when q.top_k between 1 and 100 then 'ok' else 'invalid' end as status,
       cast("rank" - 1 as int) as position, product_id, {r("score")} as score,
       score between 0 and 1 as score_in_range
from requests q left join ranked using (user_id, top_k)"""
    )
)
def brand_batch_responses(spark, sf_dir):
    requests = materialize(views.requests(spark, sf_dir), "requests")
    found = recommend_batch(_hybrid(spark, sf_dir), requests)
    flat = found.select(
        "request_id", "user_id", "top_k", "status", F.posexplode_outer("recommendations").alias("position", "item")
    )
    return flat.select(
        "request_id",
        "user_id",
        "top_k",
        "status",
        "position",
        "item.product_id",
        rounded("item.score", alias="score"),
        "item.score_in_range",
    )
