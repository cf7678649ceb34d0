"""Registered queries of the corpus operators, and SQL for those that SQL can express.

Every query applies its operator with production parameters to whole tables and derives the
contract's columns from what the operator gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    bloom_dedup, decontaminate, grouping_ga, html_consensus, jaccard_join, license_scan, line_dedup, periodic_runs, quality,
    reversed_search, segment_topk, shard_packing, token_files,
)
from plumbline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_consensus.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = grouping_ga.token_pieces(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return grouping_ga.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumn("score", F.round("score", 6))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.quality_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (quality.id_bucket(F.col("doc_id")) % 5 == 0).alias("held_out"), F.col("__score").alias("score"),
                         (F.col("__score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                       F.sha2("text", 256).alias("kept_sha256"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return segment_topk.top_k(rows, rows.where("vec_id % 20 = 0"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = token_files.token_root(spark)
    index = token_files.write_token_files(table(spark, sf_dir, "documents"), root, tokenizer_file("byte_bpe_50k.json"), end_id=2)
    return token_files.read_checksums(index, root)


def op10_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_packing.assign_shards(table(spark, sf_dir, "documents"))


def op11_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def with_planted_run(doc_id: int | None, words: list) -> list:
    """The contract's planted runs: from some word on, the words of one document in ten repeat. Rows without an id stay as they are."""
    from zlib import crc32

    h = crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    unit = words[first:first + period]
    return words[:first] + (unit * -(-(n - first) // period))[:n - first]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), prepare=with_planted_run)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


def op13_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_dedup.exact_copies(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_html_consensus": op1_html_consensus,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_license_scan": op4_license_scan,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_line_dedup": op6_line_dedup,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_segment_topk": op8_segment_topk,
    "op9_token_files": op9_token_files,
    "op10_vector_sharding": op10_vector_sharding,
    "op11_reversed_search": op11_reversed_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_bloom_dedup": op13_bloom_dedup,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _license_sql() -> str:
    """Every place of every key phrase, and the IDF share of its notice's words that stand around it."""
    text = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    notices = ", ".join(
        f"({t}, '{label}', {text(notice.split())}, {text(key.split())}, {license_scan.key_start(notice, key)})"
        for t, (label, notice, key) in enumerate(license_scan.TEMPLATES))
    phrases = ", ".join(f"('{label}', {text(phrase.split())})" for phrase, label in license_scan.BASE)
    places = "range(1, len(w) - len(key) + 2)"
    return f"""
        with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
             t(t, label, notice, key, at_word) as (values {notices}),
             b(label, key) as (values {phrases}),
             n as (select count(*) as n from d),
             idf as (select v.word, ln((n.n + 1) / (coalesce(c.c, 0) + 1)) + 0.001 as idf
                     from (select distinct unnest(notice) as word from t) v cross join n
                     left join (select word, count(*) as c from (select doc_id, unnest(list_distinct(w)) as word from d) group by word) c on v.word = c.word),
             base as (select doc_id, label, p - 1 as p from (select doc_id, w, key, label, unnest({places}) as p
                      from d join b on list_contains(w, key[1]) and list_contains(w, key[2])) where w[p : p + len(key) - 1] = key),
             hit as (select doc_id, w, t, label, notice, p - at_word as o from (select doc_id, w, t, label, notice, key, at_word, unnest({places}) as p
                     from d join t on list_contains(w, key[1]) and list_contains(w, key[2])) where w[p : p + len(key) - 1] = key),
             word as (select doc_id, t, label, o, notice[j] as word, o + j - 1 >= 1 and coalesce(w[greatest(o + j - 1, 1)] = notice[j], false) as same
                      from (select *, unnest(range(1, len(notice) + 1)) as j from hit)),
             held as (select doc_id, t, label, o, sum(idf) filter (same) / sum(idf) as s from word join idf using (word) group by all),
             bs as (select doc_id, count(*) as n_base, min(p) as first_word, max(p) as last_word, string_agg(distinct label, ',' order by label) as base_labels
                    from base group by doc_id),
             ls as (select doc_id, string_agg(distinct label, ',' order by label) as labels
                    from (select doc_id, label from base union all select doc_id, label from held) group by doc_id),
             ss as (select doc_id, max(s) as s from held group by doc_id)
        select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
               coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, round(least(1.0, coalesce(s, 0))::double, 6) as score
        from d left join bs using (doc_id) left join ls using (doc_id) left join ss using (doc_id)"""


CASES: dict[str, str] = {
    "op4_license_scan": _license_sql(),
    "op6_line_dedup": f"""
        with d as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
             k as (select doc_id, pos, line, {_KEY} as key from d),
             often as (select key from k where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
        select doc_id, count(*) as n_lines, count(*) filter (often.key is not null) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (often.key is null), '')) as kept_sha256
        from k left join often on k.key = often.key group by doc_id""",
    "op8_segment_topk": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as c from embeddings
                   where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
             s as (select q.vec_id as query_id, x.vec_id, list_sum(list_transform(list_zip(q.c, x.c), lambda p: p[1] * p[2]))::bigint as score
                   from v q join v x on q.vec_id <> x.vec_id and len(q.c) = len(x.c) where q.vec_id % 20 = 0),
             r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score from s)
        select query_id, rank, vec_id, score from r where rank <= 20""",
    "op11_reversed_search": f"""
        with d as (select doc_id, unnest({_TERMS}) as term from documents),
             n as (select doc_id, count(*) as n from d group by doc_id),
             total as (select count(*) as n_docs, sum(n)::bigint as n_terms from n),
             df as (select term, count(distinct doc_id) as df from d group by term),
             i as (select item_id, term, count(*) as times from (select item_id, unnest({_TERMS}) as term from benchmark) group by all),
             tf as (select doc_id, term, count(*) as tf from d where term in (select term from i) group by all),
             w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint as w from df cross join total),
             s as (select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::bigint as score
                   from i join tf using (term) join w using (term) join n using (doc_id) cross join total group by item_id, doc_id),
             r as (select *, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank from s where score > 0)
        select item_id, rank, doc_id, score from r where rank <= 20""",
    "op13_bloom_dedup": f"""
        with t as (select doc_id, {_LOWER} as text from documents)
        select doc_id, max(doc_id) over (partition by text) as keep_id, count(*) over (partition by text) as group_size,
               doc_id = max(doc_id) over (partition by text) as kept, sha256(text) as text_sha256
        from t""",
}
