"""The pN_ queries on documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.mixing import mixture, mixture_report
from strata.llm.packing import pack, packing_report
from strata.llm.spans import expand, linked, shared_share, shared_spans
from strata.llm.tokens import with_token_counts
from strata.session import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every decision in containers of each kind."""
    counts = with_token_counts(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text"))
    kinds = table(spark, sf_dir, "pack_capacity").select(F.col("container_kind").alias("kind"), F.col("capacity_tokens").alias("capacity"))
    return pack(counts, kinds)


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers against the lower bound, and the space used."""
    return packing_report(written(p8_pack(spark, sf_dir), "packed"))


def p8_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What any packing must hold to, per kind: every document is there with all its tokens
    (`incomplete` counts the others), no container is overfull, and no document is split that
    fits a container."""
    counts = written(with_token_counts(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")), "counts")
    kinds = table(spark, sf_dir, "pack_capacity").select(F.col("container_kind").alias("kind"), F.col("capacity_tokens").alias("capacity"))
    packed = written(pack(counts, kinds), "packed")
    per = packed.groupBy(F.col("container_kind").alias("kind"), F.col("doc_id").alias("doc")).agg(F.sum("tokens").alias("packed"), F.count("*").alias("pieces"), F.max("capacity_tokens").alias("capacity"))
    documents = counts.count()
    wrong = per.join(counts, "doc").groupBy("kind").agg(
        F.lit(documents).cast("long").alias("documents"), (F.lit(documents) - F.count_if(F.col("packed") == F.col("tokens"))).alias("incomplete"),
        F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity"))).alias("split_short"),
    )
    over = packed.groupBy("container_kind", "container_id").agg((F.sum("tokens") > F.max("capacity_tokens")).alias("over")).groupBy(F.col("container_kind").alias("kind")).agg(F.count_if("over").alias("overfull"))
    return wrong.join(over, "kind").select(F.col("kind").alias("container_kind"), "documents", "incomplete", "split_short", "overfull")


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "mix_target").select("source", F.col("target_weight").alias("weight"), F.col("max_repeats").alias("repeats"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each decision is used, and for which source."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("doc"), "source", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), F.col("text")).alias("h2"), F.length("text").alias("chars"), "text"
    )
    return mixture(with_token_counts(docs), _targets(spark, sf_dir))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares really reached."""
    return mixture_report(written(p9_mix(spark, sf_dir), "mixed"), _targets(spark, sf_dir))


def p9_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What any mixture must hold to, per target source: no decision is used more often than the
    source allows or without standing in it, and the share reached is within five points of the
    weight among the sources that have decisions."""
    mixed = written(p9_mix(spark, sf_dir), "mixed")
    same = lambda c: F.lower(F.trim(c))
    docs = table(spark, sf_dir, "documents").filter("length(text) > 0").select(same("source").alias("source"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), F.col("text")).alias("h2"), "doc_id")
    goals = _targets(spark, sf_dir).select(same("source").alias("source"), "weight", "repeats")
    live = goals.join(docs.select("source"), "source", "left_semi").withColumn("goal", F.col("weight") / F.sum("weight").over(Window.partitionBy(F.lit(1))))  # one row a source
    drawn = mixed.join(docs.select("doc_id", "h1", "h2"), "doc_id").join(docs.select("source", "h1", "h2", F.lit(True).alias("own")).distinct(), ["source", "h1", "h2"], "left").join(goals.select("source", "repeats"), "source")
    sums = drawn.groupBy("source").agg(F.sum(F.col("uses") * F.col("tokens")).alias("t"), F.count_if(F.col("uses") > F.col("repeats")).alias("over_cap"), F.count_if(F.col("own").isNull()).alias("foreign_uses"))
    sums = sums.withColumn("share", F.col("t") / F.sum("t").over(Window.partitionBy(F.lit(1))))
    out = goals.select("source").join(live.select("source", "goal"), "source", "left").join(sums, "source", "left")
    none = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select("source", F.col("goal").isNotNull().alias("has_decisions"), none("over_cap"), none("foreign_uses"), (F.abs(F.coalesce("share", F.lit(0.0)) - F.coalesce("goal", F.lit(0.0))) > 0.05).alias("share_off"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = shared_spans(table(spark, sf_dir, "documents"))
    return expand(linked(got), got["members"]).toDF("doc_id_a", "doc_id_b")


def p10_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each decision stands elsewhere."""
    return shared_share(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p8_pack, p8_report, p8_holds, p9_mix, p9_shares, p9_holds, p10_found, p10_share)}

_WINDOWS = """with w as (select doc_id, i, md5_number(substr(text, i, 200)) h from (select doc_id, text, unnest(range(1, length(text) - 198)) i from documents where length(text) >= 200)),
  r as (select h from w group by 1 having count(distinct doc_id) > 1), s as (select doc_id, i, h from w semi join r using (h))"""
SQL: dict[str, str] = {
    "p8_holds": "select container_kind, (select count(*) from documents) documents, 0::bigint incomplete, 0::bigint split_short, 0::bigint overfull from pack_capacity",
    "p9_holds": """select s source, s in (select lower(trim(source)) from documents where length(text) > 0 and source is not null) has_decisions, 0::bigint over_cap, 0::bigint foreign_uses, false share_off
      from (select lower(trim(source)) s from mix_target)""",
    "p10_found": f"{_WINDOWS}, d as (select distinct doc_id, h from s) select distinct a.doc_id doc_id_a, b.doc_id doc_id_b from d a join d b on a.h = b.h and a.doc_id < b.doc_id",
    "p10_share": f"""{_WINDOWS}, e as (select doc_id, i, lead(i) over (partition by doc_id order by i) n from s),
      t as (select doc_id, sum(least(200, coalesce(n - i, 200)))::bigint k from e group by 1)
      select doc_id, length(text)::bigint chars, coalesce(k, 0)::bigint shared_chars, case when length(text) > 0 then coalesce(k, 0) / length(text) else 0 end::double share from documents left join t using (doc_id) where text is not null""",
}
