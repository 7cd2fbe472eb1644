"""Every text operator as a query over a folder of tables, with its SQL where SQL can express it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.llm import alignment, decontam, language, mixing, neardup, packing, pii, quality
from affinia.llm import resampling, simhash, suffixdup, tokens, toxicity, urls
from affinia.sources.workspace import written


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(_documents(spark, folder), _table(spark, folder, "labels"))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.language(_documents(spark, folder))


def op3_minhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_documents(spark, folder)).drop("text_id")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.toxicity(_documents(spark, folder), _table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "evidence")


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.decontamination(
        _documents(spark, folder), _table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mix(_documents(spark, folder))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.edited_fingerprints(_documents(spark, folder))


def simhash_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Documents within three bits of every document whose id is divisible by 100."""
    prints = written(simhash.fingerprints(_documents(spark, folder)), "fingerprints")
    return simhash.neighbours(prints.where("doc_id % 100 = 0"), prints, 3)


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixdup.without_repeats(_documents(spark, folder)).drop("spans")


def op9_urls(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.verdicts(_table(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.findings(_documents(spark, folder))
    base = F.filter("spans", lambda x: x["plain"])
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = resampling.resample(_documents(spark, folder), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    first = (tokens.ByteLevel, _vocabulary("byte_bpe_50k.json"))
    second = (tokens.Pieces, _vocabulary("piece_bpe_32k.model"))
    return alignment.alignment_digests(_documents(spark, folder), first, second)


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = (tokens.WordEnds, _vocabulary("word_bpe_49k.json"))
    return packing.pieces(_documents(spark, folder), vocabulary, digest=True)


def _judged(scored: DataFrame, *others: str) -> DataFrame:
    """What SQL can say about scored documents."""
    within = F.col("score").between(0, 1).alias("in_range")
    return scored.select("doc_id", "held_out", within, *others)


def _consistent(scored: DataFrame) -> DataFrame:
    same = F.col("predicted") == (F.col("score") >= 0.5).cast("int")
    return _judged(scored.withColumn("consistent", same), "consistent")


def quality_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _consistent(op1_quality(spark, folder))


def toxicity_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _consistent(op4_toxicity(spark, folder))


def language_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Which texts have no language, and whether all others have one of those learned."""
    known = _documents(spark, folder).select(F.col("lang").alias("lang_pred")).distinct().withColumn("learned", F.lit(True))
    found = op2_language(spark, folder).join(known.where("lang_pred IS NOT NULL"), "lang_pred", "left")
    is_und = F.col("lang_pred") == "und"
    valid = is_und | F.coalesce("learned", F.lit(False))
    return _judged(found.withColumns({"is_und": is_und, "valid": valid}), "is_und", "valid")


def simhash_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Lengths and edited texts, and whether both likenesses are shares."""
    within = F.col("near_edited").between(0, 1) & F.col("near_next").between(0, 1)
    return op7_simhash(spark, folder).select("doc_id", "n_chars", "edited_sha256", within.alias("in_range"))


def url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of URLs, the rule that fits, and the verdict where one does."""
    ruled = F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("ruled")
    valid = F.col("verdict").isin("allow", "block").alias("valid")
    return op9_urls(spark, folder).select("page_id", "host", "path", "rule", ruled, valid)


def pii_base(spark: SparkSession, folder: str) -> DataFrame:
    """Plain findings."""
    return op10_pii(spark, folder).drop("spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_language": op2_language,
    "op3_minhash_neardup": op3_minhash_neardup,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_source_mix": op6_source_mix,
    "op7_simhash": op7_simhash,
    "simhash_neighbours": simhash_neighbours,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_urls": op9_urls,
    "op10_pii": op10_pii,
    "op11_resampling": op11_resampling,
    "op12_alignment": op12_alignment,
    "op13_packing": op13_packing,
    "quality_rows": quality_rows,
    "language_rows": language_rows,
    "toxicity_rows": toxicity_rows,
    "simhash_columns": simhash_columns,
    "url_rules": url_rules,
    "pii_base": pii_base,
}

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Words of texts by position; windows of each length that occurs; words covered by a match.
_OP5 = rf"""
WITH lowered AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
doc_words AS (SELECT doc_id, regexp_extract_all(text, '{_WORD}') AS w FROM lowered),
item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size,
           array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(len(w) - least(len(w), 10) + 1)) AS i
          FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT doc_id, i, size, array_to_string(w[i + 1 : i + size], ' ') AS words
    FROM (SELECT doc_id, w, size, unnest(range(greatest(len(w) - size + 1, 0))) AS i
          FROM doc_words, sizes)),
hits AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, words)),
covered AS (
    SELECT doc_id, count(DISTINCT word) AS n FROM (
        SELECT doc_id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY 1),
found AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n, 0) AS BIGINT) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

# The threshold over hashes in order; the share of each source as the level of water.
_OP6 = r"""
WITH sizes AS (
    SELECT doc_id, source,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 15))::BIGINT
               AS hash
    FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY 1),
weighed AS (
    SELECT *, CAST(list_extract([5, 2, 1],
               (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) AS DOUBLE) AS weight,
           CAST(source_size * 2 AS DOUBLE) AS cap
    FROM sums),
levels AS (
    SELECT *, cap / weight AS level,
           CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS budget FROM weighed),
filled AS (
    SELECT *, sum(cap) OVER upto + level * (sum(weight) OVER () - sum(weight) OVER upto) <= budget
              AS is_full
    FROM levels
    WINDOW upto AS (ORDER BY level, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
planned AS (
    SELECT source, source_size,
           CASE WHEN is_full THEN cap
                ELSE (budget - sum(CASE WHEN is_full THEN cap ELSE 0.0::DOUBLE END) OVER ())
                     / sum(CASE WHEN is_full THEN 0.0::DOUBLE ELSE weight END) OVER () * weight
           END AS target
    FROM filled),
rests AS (
    SELECT *, target - times * source_size AS rest FROM (
        SELECT *, CASE WHEN source_size = 0 THEN 0
                       ELSE CAST(floor(target / source_size) AS BIGINT) END AS times FROM planned)),
steps AS (
    SELECT source, hash, n, CAST(sum(n) OVER (PARTITION BY source ORDER BY hash) AS BIGINT) AS upto
    FROM (SELECT source, hash, CAST(sum(size) AS BIGINT) AS n FROM sizes GROUP BY 1, 2)),
edges AS (
    SELECT r.source, min(hash) AS threshold, arg_min(n, hash) AS edge, arg_min(upto - n, hash) AS below
    FROM steps s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source WHERE upto > rest GROUP BY 1)
SELECT doc_id, size, source_size, target,
       size * (times + CASE WHEN threshold IS NULL OR hash < threshold
                                 OR (hash = threshold AND (rest - below) * 2 > edge)
                            THEN 1 ELSE 0 END) AS taken
FROM sizes s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
LEFT JOIN edges e ON s.source IS NOT DISTINCT FROM e.source
"""

# Components by following links from every document.
_OP3 = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, least(len(w), 1)))) AS i FROM texts)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles x JOIN shingles y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM common o JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * o.n >= 85 * (x.n + y.n - o.n)),
reached AS (
    SELECT doc_id, doc_id AS root FROM documents
    UNION
    SELECT b, root FROM reached JOIN links ON a = doc_id),
found AS (SELECT doc_id, min(root) AS component_id FROM reached GROUP BY 1)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
       doc_id = component_id AS kept
FROM texts JOIN found USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

# Windows by their digest; runs of covered bytes; the bytes between them.
_OP8 = r"""
WITH texts AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
windows AS (
    SELECT doc_id, i, md5(t[i + 1 : i + 200]) AS digest
    FROM (SELECT doc_id, t, unnest(range(octet_length(t) - 199)) AS i
          FROM texts WHERE octet_length(t) >= 200)),
repeated AS (SELECT digest FROM windows GROUP BY 1 HAVING count(*) > 1),
marked AS (
    SELECT doc_id, i, i > 200 + lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS opens
    FROM windows SEMI JOIN repeated USING (digest)),
runs AS (
    SELECT doc_id, min(i) AS start, max(i) + 200 AS stop
    FROM (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked)
    GROUP BY doc_id, run),
edges AS (
    SELECT doc_id, start, stop,
           coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS since FROM runs
    UNION ALL
    SELECT doc_id, octet_length(t), NULL, coalesce(last_stop, 0)
    FROM texts LEFT JOIN (SELECT doc_id, max(stop) AS last_stop FROM runs GROUP BY 1) USING (doc_id)),
kept AS (
    SELECT doc_id, coalesce(sum(stop - start), 0) AS n_removed, count(stop) AS n_spans,
           unhex(string_agg(CASE WHEN start > since THEN hex(t[since + 1 : start]) ELSE '' END, ''
                            ORDER BY start)) AS bytes
    FROM edges JOIN texts USING (doc_id) GROUP BY 1)
SELECT doc_id, CAST(octet_length(t) AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed,
       CAST(n_spans AS BIGINT) AS n_spans, sha256(bytes) AS kept_sha256
FROM texts JOIN kept USING (doc_id)
"""

# The checksum of a text, one byte after the other.
_CRC = r"""
WITH crc AS (
    SELECT list(c ORDER BY i) AS steps FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
        FROM range(256) t(i)))
"""


def _crc32(text: str) -> str:
    return rf"""xor(4294967295, list_reduce(
               list_concat([4294967295], list_transform(range(octet_length(encode({text}))),
                   lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)),
               lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])))"""


def _held_out(folds: int, remainder: int, columns: str, others: str = "") -> str:
    """Folds of all documents with columns that are the same for all."""
    return f"""{_CRC}
        SELECT doc_id, coalesce({_crc32("doc_id::VARCHAR")} % {folds} = {remainder}, false) AS held_out,
               true AS in_range, {columns} FROM documents, crc {others}"""


# Documents in descending order of ids, the first one after the last.
_SIMHASH_COLUMNS = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
pairs AS (
    SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS after
    FROM texts)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(left(t, n - n // 3) || left(after, n // 3)) AS edited_sha256,
       true AS in_range
FROM pairs
"""

_URL_RULES = f"""
WITH parts AS (
    SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules AS (SELECT * FROM (VALUES {", ".join(str(x) for x in urls.RULES)}) r(h, p, verdict)),
fitting AS (
    SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS ruled
    FROM parts, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY 1)
SELECT page_id, host, path, rule, ruled, true AS valid FROM parts LEFT JOIN fitting USING (page_id)
"""

# What is between matches gives their places. A failing match is dropped where it was found.
_PII_BASE = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
kinds AS (SELECT * FROM (VALUES
    (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'),
    (1, 'ip', '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'),
    (2, 'card', '[0-9](?:[\x20-]?[0-9])+'),
    (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]')) k(place, kind, pattern)),
cut AS (
    SELECT doc_id, place, kind, regexp_extract_all(t, pattern) AS m, string_split_regex(t, pattern) AS gaps
    FROM texts, kinds),
each AS (
    SELECT doc_id, place, kind, unnest(range(len(m))) AS i, unnest(m) AS found, unnest(gaps[:len(m)]) AS gap FROM cut),
placed AS (
    SELECT *, sum(length(gap) + length(found)) OVER (PARTITION BY doc_id, place ORDER BY i) AS stop,
           regexp_replace(found, '[^0-9]', '', 'g') AS digits FROM each),
good AS (
    SELECT * FROM placed WHERE CASE kind
        WHEN 'email' THEN true
        WHEN 'ip' THEN list_bool_and(list_transform(string_split(found, '.'), lambda x:
            length(ltrim(x, '0')) <= 3 AND coalesce(try_cast(nullif(ltrim(x, '0'), '') AS INT), 0) <= 255))
        WHEN 'card' THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(length(digits)), lambda i:
            CASE WHEN i % 2 = 0 THEN reverse(digits)[i + 1]::INT
                 WHEN reverse(digits)[i + 1]::INT > 4 THEN reverse(digits)[i + 1]::INT * 2 - 9
                 ELSE reverse(digits)[i + 1]::INT * 2 END)) % 10 = 0
        ELSE length(digits) BETWEEN 8 AND 15 END),
sums AS (
    SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
           count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
           string_agg(kind || ':' || (stop - length(found))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY place, i) AS spans
    FROM good GROUP BY 1)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(spans, '')) AS base_sha256
FROM texts LEFT JOIN sums USING (doc_id)
"""

# Gains of buckets of word checksums; ranks by a sort.
_OP11 = _CRC + r""",
source_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '{word}') AS w FROM documents),
target_words AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '{word}')) AS word FROM benchmark),
every AS (SELECT doc_id, unnest(w) AS word FROM source_words),
buckets AS (
    SELECT word, {crc32} % 10000 AS bucket
    FROM (SELECT word FROM every UNION SELECT word FROM target_words), crc),
s AS (SELECT bucket, count(*) AS n FROM every JOIN buckets USING (word) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM target_words JOIN buckets USING (word) GROUP BY 1),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln(
               (coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM every) + 10000)::DOUBLE
               / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM target_words) + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM s LEFT JOIN t USING (bucket)),
weights AS (
    SELECT doc_id, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
    FROM every JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY 1),
scored AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
               (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT)
               AS score
    FROM source_words LEFT JOIN weights USING (doc_id)),
ranks AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranks USING (doc_id)
""".replace("{word}", _WORD).replace("{crc32}", _crc32("word"))

ORACLES: dict[str, str] = {
    "op3_minhash_neardup": _OP3,
    "op5_decontamination": _OP5,
    "op6_source_mix": _OP6,
    "op8_suffix_dedup": _OP8,
    "op11_resampling": _OP11,
    "quality_rows": _held_out(3, 1, "true AS consistent"),
    "toxicity_rows": _held_out(5, 0, "true AS consistent"),
    "language_rows": _held_out(
        5, 0, r"NOT regexp_matches(coalesce(text, ''), '\p{L}') AS is_und, true AS valid"
    ),
    "simhash_columns": _SIMHASH_COLUMNS,
    "url_rules": _URL_RULES,
    "pii_base": _PII_BASE,
}
