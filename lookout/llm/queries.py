"""The operators' queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

import textwrap
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = textwrap.dedent(sql).strip()
        return fn
    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_suffix")
def op1_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix import deduplicated

    return deduplicated(read(spark, sf_dir, "documents"))


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import personal_data

    return personal_data(read(spark, sf_dir, "documents"))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import scored

    return scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op4_embedding")
def op4_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding import near_duplicates

    return near_duplicates(read(spark, sf_dir, "embeddings"))


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import packed

    return packed(read(spark, sf_dir, "documents"), tokenizer_path(), ids=False)


def _license_sql() -> str:
    """The same texts, patterns and spellings; digests of the known texts are made in plain Python."""
    import hashlib

    from . import licenses as L

    def replaced(x: str, spellings) -> str:
        for old, new in spellings:
            x = f"replace({x}, '{old}', '{new}')"
        return x

    names: dict[str, str] = {}
    for name, text in L.published():
        c = L.canonical_text(text)
        if c:
            digest = hashlib.sha256(c.encode()).hexdigest()
            names[digest] = min(name, names.get(digest, name))
    signs = r"[\x00-\x09\x0b-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f\x{a0}\x{201c}\x{201d}\x{2018}\x{2019}\x{2013}\x{2014}\x{2026}\x{a9}\x{ae}\x{2122}]+"
    lines = f"translate(regexp_replace(coalesce(text, ''), '{L.OWNED}', chr(10), 'g'), '{L.UPPER}', '{L.LOWER}')"
    lines = replaced(f"regexp_replace({lines}, '{signs}', ' ', 'g')", L.SPELLINGS)
    whole = replaced("trim(regexp_replace(l, '[ \\n]+', ' ', 'g'), ' ')", [x for x in L.SPELLINGS if " " in x[0]])
    known = ", ".join(f"('{digest}', '{name}')" for digest, name in sorted(names.items()))
    return f"""
    WITH known(digest, license_id) AS (VALUES {known}),
    d AS (SELECT row_number() OVER () AS r, doc_id, {lines} AS l FROM documents),
    w AS (SELECT r, doc_id, l, {whole} AS w FROM d),
    e AS (SELECT r, unnest(string_split(l, chr(10))) AS line FROM w),
    h AS (SELECT r, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
          FROM e JOIN known ON sha256(trim(e.line, ' ')) = known.digest GROUP BY r)
    SELECT w.doc_id, CAST(length(w.w) AS BIGINT) AS n_canonical, sha256(w.w) AS digest, known.license_id,
           CAST(coalesce(h.n, 0) AS BIGINT) AS n_notices, h.notices
    FROM w LEFT JOIN known ON sha256(w.w) = known.digest LEFT JOIN h ON h.r = w.r"""


@query("op6_license", _license_sql())
def op6_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    return scan(read(spark, sf_dir, "documents"))


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identified

    return identified(read(spark, sf_dir, "documents"))


@query("op8_mixing", r"""
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
      FROM documents),
    s AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS rk
      FROM d GROUP BY source),
    w AS (
      SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w, CAST(2 * source_size AS BIGINT) AS full_size FROM s),
    l AS (
      SELECT *, row_number() OVER o AS pos,
             (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - CAST(coalesce(sum(full_size) OVER b, 0) AS DOUBLE))
               / CAST(sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS DOUBLE) AS level
      FROM w
      WINDOW o AS (ORDER BY CAST(full_size AS DOUBLE) / w, rk),
             b AS (ORDER BY CAST(full_size AS DOUBLE) / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    f AS (SELECT min(pos) AS pos, arg_min(level, pos) AS level FROM l WHERE level * w <= full_size),
    t AS (
      SELECT l.source, l.source_size,
             CASE WHEN f.pos IS NULL OR l.pos < f.pos THEN CAST(l.full_size AS DOUBLE) ELSE f.level * l.w END AS target
      FROM l, f),
    q AS (
      SELECT d.*, t.source_size, t.target, CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fin
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target,
           CAST(least(greatest(floor(target) - (fin - size), 0), size) + least(greatest(floor(target) - (fin - size) - source_size, 0), size) AS BIGINT) AS taken,
           CASE WHEN target > 0 THEN fin / target END AS finish
    FROM q
""")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import queue

    return queue(read(spark, sf_dir, "documents"))


@query("op9_minhash")
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"), words=4)


@query("op10_nearest")
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    return nearest(read(spark, sf_dir, "embeddings"))


def _centroid_sql(rounds: int = 10) -> str:
    """One pair of assignment and means for each round."""
    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
      SELECT r, c, dist FROM (SELECT p.r, c.c, sum((p.x - c.y) * (p.x - c.y)) AS dist FROM p JOIN c{i} c ON p.d = c.d GROUP BY p.r, c.c)
      QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, c) = 1)"""

    def means(i: int) -> str:
        return f"""c{i + 1} AS MATERIALIZED (
      SELECT c.c, c.d, coalesce(m.y, c.y) AS y FROM c{i} c LEFT JOIN (
        SELECT a.c, p.d, CAST(floor(sum(p.x) / count(*)) AS BIGINT) AS y FROM a{i} a JOIN p ON a.r = p.r GROUP BY a.c, p.d) m ON m.c = c.c AND m.d = c.d)"""

    steps = ",\n    ".join(f"{assigned(i)},\n    {means(i)}" for i in range(rounds))
    return f"""
    WITH kept AS MATERIALIZED (
      SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    p AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM kept),
    f AS (SELECT v, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), v) - 1 AS c FROM kept QUALIFY c < 8),
    c0 AS MATERIALIZED (SELECT c, unnest(v) AS y, generate_subscripts(v, 1) AS d FROM f),
    {steps},
    {assigned(rounds)},
    s AS (SELECT c, CAST(sum(dist) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY c),
    h AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
    SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.dist AS BIGINT) AS distance, s.cluster_inertia,
           (SELECT CAST(sum(cluster_inertia) AS BIGINT) FROM s) AS inertia, h.centroid_sha256
    FROM a{rounds} a JOIN kept k ON k.r = a.r JOIN s ON s.c = a.c JOIN h ON h.c = a.c"""


@query("op11_centroids", _centroid_sql())
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import clustered

    return clustered(read(spark, sf_dir, "embeddings"))


@query("op12_lexical", r"""
    WITH w AS (
      SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
      FROM documents WHERE text IS NOT NULL),
    d AS (SELECT r, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM w WHERE len(terms) > 0),
    t AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
    o AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
    f AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(t.docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM o, t GROUP BY term),
    i AS (
      SELECT item, item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
      FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)),
    s AS (
      SELECT i.item, i.item_id, d.r, d.doc_id,
             CAST(sum(f.weight * ((1000000000 * o.tf) // (1000 * o.tf + 8 * (100 - 90 + (90 * d.n * t.docs) // t.total)))) AS BIGINT) AS score
      FROM i JOIN f ON f.term = i.term JOIN o ON o.term = i.term JOIN d ON d.r = o.r, t
      GROUP BY i.item, i.item_id, d.r, d.doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM s WHERE score > 0
    QUALIFY rank <= 10
""")
def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexical import ranked

    return ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op13_bestfit")
def op13_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bestfit import packed

    return packed(read(spark, sf_dir, "documents"), tokenizer_path())
