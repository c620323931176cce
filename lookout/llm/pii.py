"""Information-theoretic sanitising of personal data, in DataFrame functions alone: co-occurrence over whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: kind -> (pattern, condition on a match ``m``, condition on the text that every text with a valid match meets). The patterns give the matches
#: of the plain ones, leftmost and non-overlapping, but never go back: long texts cost time in proportion.
KINDS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true", "contains(t, '@')"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
           r"m rlike '^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$'",
           r"t rlike '[0-9]\\.[0-9]++\\.[0-9]++\\.[0-9]'"),
    "card": (r"[0-9](?:[ -]?+[0-9])++",
             "length(regexp_replace(m, '[ -]', '')) between 16 and 19 and luhn_check(regexp_replace(m, '[ -]', ''))",
             "t rlike '[0-9](?:[ -]?+[0-9]){15}'"),
    "phone": (r"\+[0-9](?:[ ().-]*+[0-9])++", "length(regexp_replace(m, '[^0-9]', '')) between 8 and 15", "contains(t, '+')"),
}
NAMES = [*KINDS, "term"]
#: a term: a run of letters and digits
TERM = r"[\p{L}\p{N}]++"
_HITS = "array<struct<kind:int,start:int,stop:int,m:string>>"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def _found(text: str, pattern: str, valid: str, kind: int, column: str | None = None) -> str:
    """SQL for the valid matches with their places: the pieces between matches and the matches give running lengths.
    ``column``: the pattern of each row instead."""
    p = column or _quoted(pattern)
    return f"""aggregate(
        zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), (a, m) -> named_struct('before', length(a), 'm', m)),
        named_struct('at', 0, 'hits', cast(array() as {_HITS})),
        (s, x) -> named_struct('at', s.at + x.before + coalesce(length(x.m), 0),
            'hits', if(x.m is not null and ({valid.replace("m ", "x.m ").replace("(m,", "(x.m,")}),
                       concat(s.hits, array(named_struct('kind', {kind}, 'start', s.at + x.before, 'stop', s.at + x.before + length(x.m), 'm', x.m))),
                       s.hits)),
        s -> s.hits)"""


def base_hits(text: str) -> Column:
    """The base spans of a text column as an array of (kind, start, stop, m), by kind, then start; code points, end exclusive."""
    none = f"cast(array() as {_HITS})"
    parts = []
    for i, (pattern, valid, needs) in enumerate(KINDS.values()):
        needs = needs.replace("(t,", f"({text},").replace("t rlike", f"{text} rlike")
        parts.append(f"if(coalesce({needs}, false), {_found(text, pattern, valid, i)}, {none})")
    return F.expr(f"concat({', '.join(parts)})")


#: the text with every base span as one space
_BARE = """aggregate(array_sort(transform(_hits, h -> named_struct('start', h.start, 'stop', h.stop))), named_struct('at', 0, 'out', ''),
    (s, x) -> named_struct('at', greatest(s.at, x.stop), 'out', if(x.start >= s.at, concat(s.out, substring(_text, s.at + 1, x.start - s.at), ' '), s.out)),
    s -> concat(s.out, substring(_text, s.at + 1)))"""
_SPANS = "array<struct<kind:int,start:int,stop:int>>"


def _revealing(rows: DataFrame, source: DataFrame, threshold: float, specific: float, support: int, broadcast_rows: int) -> DataFrame:
    """``digest, words``: the terms of each text that disclose one of its entities beyond the threshold.

    Copies of a text are one text from here on, with their number. Entities that too few texts hold go first, then the
    pairs of entity and term are counted, and the other documents only for the terms that are left.
    """
    texts = rows.where("digest is not null").groupBy("digest").agg(F.count("*").alias("n"), F.first("entities").alias("entities"), F.first("words").alias("words"))
    texts, _ = table(texts)
    held = texts.select("digest", "n", F.explode("entities").alias("entity"))
    enough = [F.sum("n").alias("docs"), F.count("*").alias("texts")]
    entity = held.groupBy("entity").agg(*enough).where(F.col("texts") >= support).select("entity", F.col("docs").alias("with_entity"))
    entity, _ = table(entity)
    few = entity.count() <= broadcast_rows  # sixteen bytes each; otherwise both sides are shuffled
    mine = texts.select("digest", "n", "words", F.explode("entities").alias("entity")).join(F.broadcast(entity) if few else entity, "entity")
    pairs = mine.select("digest", "n", "entity", "with_entity", F.explode("words").alias("term"))
    near = pairs.groupBy("entity", "term").agg(F.max("with_entity").alias("with_entity"), *enough).where(F.col("texts") >= support)
    near, _ = table(near.withColumnRenamed("docs", "together"))
    terms = near.select("term").distinct()
    # document frequencies over the whole corpus, of the terms in question
    words = source.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("_text"), F.lit(TERM), F.lit(0)))).alias("term"))
    few = terms.agg(F.coalesce(F.sum(F.length("term") + 40), F.lit(0))).first()[0] <= 64 * broadcast_rows
    frequency = words.join(F.broadcast(terms) if few else terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("with_term"))
    total = float(rows.count())
    information = F.log2(F.lit(total) / F.col("with_entity"))
    mutual = F.log2(F.col("together") * F.lit(total) / (F.col("with_term") * F.col("with_entity")))
    reveals = (near.join(frequency, "term").where((information > 0) & (mutual >= threshold * information) & (F.col("together") >= specific * F.col("with_term")))
               .select("entity", "term"))
    reveals, _ = table(reveals)
    few = reveals.agg(F.coalesce(F.sum(F.length("term") + 48), F.lit(0))).first()[0] <= 64 * broadcast_rows
    found = pairs.join(F.broadcast(reveals) if few else reveals, ["entity", "term"], "left_semi")
    return found.groupBy("digest").agg(F.sort_array(F.collect_set("term")).alias("words"))


def _with_terms(rows: DataFrame, words: DataFrame, digest: Column, text: str, broadcast_rows: int) -> DataFrame:
    """``rows`` with ``terms``: the spans of their disclosing terms in ``text``, wherever they stand outside base spans.

    A text's own terms make its pattern. Terms are letters and digits, so none of them is a sign of the pattern."""
    words, _ = table(words)
    few = words.agg(F.coalesce(F.sum(F.aggregate("words", F.lit(40), lambda a, w: a + F.length(w) + 8)), F.lit(0))).first()[0] <= 64 * broadcast_rows
    words = words.withColumnsRenamed({"digest": "_d", "words": "_w"})
    out = rows.join(F.broadcast(words) if few else words, digest == F.col("_d"), "left")
    out = out.withColumn("_p", F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join("_w", "|"), F.lit(r")(?![\p{L}\p{N}])")))
    spans = F.expr(f"filter({_found(text, TERM, 'true', len(KINDS), '_p')}, x -> not exists(_hits, b -> x.start < b.stop and x.stop > b.start))")
    spans = F.transform(spans, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")))
    return out.withColumn("terms", F.when(F.col("_w").isNotNull(), spans).otherwise(F.expr(f"cast(array() as {_SPANS})"))).drop("_p", "_d", "_w")


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.9, specific: float = 0.5, support: int = 2,
                  broadcast_rows: int = 1_000_000) -> DataFrame:
    """One row per document: ``key``, counts of base spans by kind, ``base_sha256`` and ``spans``.

    Base spans (email, ip, card with Luhn, phone) are the protected entities. A term, any run of letters and digits
    outside them, reveals an entity by their pointwise mutual information over whole documents, log2 p(e, t) / (p(e) p(t)):
    it does where that is at least ``threshold`` of the entity's own information, log2 1 / p(e), and at least the share
    ``specific`` of the documents with the term hold the entity, which leaves alone the words of a template that names others
    as well. Then all mentions of the term in documents that hold the entity are spans of kind ``term`` as well.
    At least ``support`` different texts must show both: what surrounds an entity of a single text, or of copies
    of one, says nothing yet of which words belong to it, so such entities have base spans alone.

    Null text counts as empty and has no spans; a null key is a key; a document that comes twice counts twice and has
    its row twice; empty tables give empty results. Other columns are not read.
    """
    rows, words = _analysed(docs, key, text, threshold, specific, support, broadcast_rows)
    hit = _with_terms(rows.where("digest is not null"), words, F.col("digest"), "_text", broadcast_rows).select("key", "_hits", "terms")
    clean = rows.where("digest is null").select("key", "_hits", F.expr(f"cast(array() as {_SPANS})").alias("terms"))
    name = "element_at(array(" + ", ".join(f"'{n}'" for n in NAMES) + "), s.kind + 1)"
    joined = "array_join(transform({}, s -> concat(" + name + ", ':', s.start, ':', s.stop)), ',')"
    counts = [F.expr(f"cast(size(filter(_hits, h -> h.kind = {i})) as long)").alias(f"n_{n}") for i, n in enumerate(KINDS)]
    everything = "concat(transform(_hits, h -> named_struct('kind', h.kind, 'start', h.start, 'stop', h.stop)), terms)"
    return clean.unionByName(hit).select(
        F.col("key").alias(key), *counts, F.sha2(F.expr(joined.format("_hits")), 256).alias("base_sha256"),
        F.expr(joined.format(everything)).alias("spans"), F.size("terms").cast("long").alias("n_term"))


def _analysed(docs: DataFrame, key: str, text: str, threshold: float, specific: float, support: int, broadcast_rows: int):
    """Documents with their base spans, of those that have any also text, digest, entities and distinct terms; and ``_revealing``."""
    source = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = source.withColumn("_hits", base_hits("_text"))
    some = F.size("_hits") > 0
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.expr(_BARE)), F.lit(TERM), F.lit(0)))
    rows = rows.select("key", "_hits", F.when(some, F.col("_text")).alias("_text"), F.when(some, F.md5("_text")).alias("digest"),
                       F.when(some, F.expr("array_distinct(transform(_hits, h -> xxhash64(h.kind, lower(h.m))))")).alias("entities"), F.when(some, words).alias("words"))
    rows, _ = table(rows)
    return rows, _revealing(rows, source, threshold, specific, support, broadcast_rows)


def sanitised(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.9, specific: float = 0.5, support: int = 2,
              broadcast_rows: int = 1_000_000) -> DataFrame:
    """``docs`` with its columns, in whose texts every span of ``personal_data`` is replaced by its kind in brackets.

    Overlapping spans become one replacement. Texts without spans, null ones included, pass unchanged and unshuffled.
    """
    _, words = _analysed(docs, key, text, threshold, specific, support, broadcast_rows)
    columns = docs.columns
    inner = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    t = f"_c{columns.index(text)}"
    inner = inner.withColumn("_hits", F.coalesce(base_hits(t), F.expr(f"cast(array() as {_HITS})")))
    clean = inner.where("size(_hits) = 0").drop("_hits")
    found = _with_terms(inner.where("size(_hits) > 0"), words, F.md5(t), t, broadcast_rows)
    names = "array(" + ", ".join(f"'[{n.upper()}]'" for n in NAMES) + ")"
    order = """array_sort(concat(transform(_hits, h -> named_struct('start', h.start, 'stop', h.stop, 'kind', h.kind)),
        transform(terms, h -> named_struct('start', h.start, 'stop', h.stop, 'kind', h.kind))))"""
    new = F.expr(f"""aggregate({order}, named_struct('at', 0, 'out', ''),
        (s, x) -> named_struct('at', greatest(s.at, x.stop), 'out',
            if(x.start >= s.at, concat(s.out, substring({t}, s.at + 1, x.start - s.at), element_at({names}, x.kind + 1)), s.out)),
        s -> concat(s.out, substring({t}, s.at + 1)))""")
    found = found.withColumn(t, new).drop("_hits", "terms")
    return clean.unionByName(found).select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)])
