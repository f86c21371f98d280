"""Registered queries of the numbered operators, and their DuckDB oracles.

Each query reads its whole table, passes it through its operator with
production parameters and derives the contract's columns from the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import (chat, conversation_repair, decontaminate, exact_dedup, filter_audit, mixing, near_dup, oracles,
                             packing, quality, set_join, sharding, token_files, toxicity)

SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, [("user", said), ("assistant", said)])],
        "conv_id long, messages array<struct<role: string, content: string>>")
    turns = chat.canonical_turns(table(spark, sf_dir, "conversations")).unionByName(chat.canonical_turns(extra))
    return chat.read_back(chat.format_turns(turns))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = sharding.assign_shards(table(spark, sf_dir, "documents"), [1.0] * SHARDS, new_weight=1.0)
    return sharding.number_slots(assigned).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def q_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.count_document_tokens(table(spark, sf_dir, "documents"))


def q_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def q_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_streams(table(spark, sf_dir, "documents"))
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def q_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.exact_groups(
        docs, carry={"text_sha256": F.sha2(exact_dedup.ascii_lower(F.col("text")), 256)})


def q_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def q_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.join_sets(table(spark, sf_dir, "documents"), shingle=4, percent=85)


def q_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_conversations(damaged).withColumnRenamed("id", "conv_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": q_chat,
    "op2_quality": q_quality,
    "op3_toxicity": q_toxicity,
    "op4_rendezvous_shards": q_shards,
    "op5_token_packing": q_pack,
    "op6_token_counts": q_token_counts,
    "op7_benchmark_leaks": q_leaks,
    "op8_source_mix": q_mix,
    "op9_exact_dedup": q_exact,
    "op10_near_dup": q_near,
    "op11_filter_audit": q_audit,
    "op12_ngram_join": q_sets,
    "op13_conversation_repair": q_repair,
}

WORDS_SQL = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

ORACLE: dict[str, str] = {
    "op1_chat_format": r"""
        with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
                   union all select -7, 0, 'user', '\### Assistant: </turn> ok'
                   union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), ''))
                   as loss_sha256,
               sum(4 + case when role in ('user', 'assistant', 'system') then length(role)
                            else 1 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) end
                   + 2 + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) + 9)::bigint as formatted_chars
        from t group by conv_id""",
    "op8_source_mix": rf"""
        with d as (select doc_id, source, {WORDS_SQL}::bigint as size,
                          ('0x' || substr(md5('20|' || coalesce(doc_id::varchar, '~')), 1, 15))::bigint as h
                   from documents),
        s as (select source, sum(size)::bigint as n from d group by source),
        w as (select source, n, case (row_number() over (order by source nulls last) - 1) % 3
                                when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as w from s),
        f as (select *, 1.5::double * (sum(n) over ())::double
                        - coalesce(sum(2.0::double * n) over (order by 2.0::double * n / w, source nulls last
                                    rows between unbounded preceding and 1 preceding), 0) as funds,
                     sum(w) over (order by 2.0::double * n / w, source nulls last
                                  rows between current row and unbounded following) as rest from w),
        c as (select *, funds * w > 2.0::double * n * rest as full_up from f),
        m as (select max(rest) as rest, max_by(funds, rest) as funds from c where not full_up),
        t as (select c.source, c.n, case when full_up then 2.0::double * n else m.funds * w / m.rest end as target
              from c, m),
        p as (select d.*, sum(size) over (partition by source order by h, doc_id) - size as at from d)
        select p.doc_id, p.size, t.n as source_size, t.target,
               (greatest(0, least(p.size, round(t.target)::bigint - p.at))
                + greatest(0, least(p.size, round(t.target)::bigint - p.at - t.n)))::bigint as taken
        from p join t on p.source is not distinct from t.source""",
    "op9_exact_dedup": """
        with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz') as t from documents),
        g as (select t, max(doc_id) as keep_id, count(*) as group_size from d group by t)
        select d.doc_id, g.keep_id, g.group_size, d.doc_id is not distinct from g.keep_id as kept,
               sha256(d.t) as text_sha256
        from d join g using (t)""",
    "op10_near_dup": oracles.set_links(3, 85, kept=True),
    "op11_filter_audit": oracles.FILTER_AUDIT,
    "op12_ngram_join": oracles.set_links(4, 85),
    "op13_conversation_repair": oracles.CONVERSATION_REPAIR,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
