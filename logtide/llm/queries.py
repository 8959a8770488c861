"""Registered queries of the operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm import (
    alignment,
    bpe,
    exact,
    lexical,
    licenses,
    packing,
    personal,
    pitman_yor,
    quality,
    simhash,
    substring_tree,
    suffix_array,
    token_orc,
)
from logtide.llm.shared import documents, shared_path

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def vocabulary_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, placed at source/language/thousand/doc_id."""
    docs = documents(spark, sf_dir)
    folder = F.floor(F.col("doc_id") / 1000).cast("long").cast("string")
    path = F.concat_ws("/", "source", "lang", folder, F.col("doc_id").cast("string"))
    found = licenses.scan(docs.select(path.alias("path"), "text"))
    doc_id = F.element_at(F.split("path", "/"), -1).cast("long").alias("doc_id")
    return found.select(doc_id, "own_license", "score", "license", "license_dir")


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded texts of all documents, as digests."""
    path = vocabulary_path()
    decoded = bpe.decode(bpe.encode(documents(spark, sf_dir), path), path)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.judge(documents(spark, sf_dir))


def op4_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files, read back and summed up."""
    out = shared_path(spark, "tokens")
    token_orc.write_tokens(documents(spark, sf_dir), vocabulary_path(), out)
    return token_orc.checksums(token_orc.read_tokens(spark, out))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into pieces and packed into sequences of 1024 tokens."""
    pieces = packing.token_pieces(documents(spark, sf_dir), vocabulary_path())
    return packing.pack(pieces).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    return exact.exact_groups(documents(spark, sf_dir))


def op7_substring_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left in every document once repeated passages are taken out."""
    cut = substring_tree.remove_repeats(documents(spark, sf_dir), kept=lambda text: F.sha2(text, 256))
    return cut.withColumnRenamed("kept_text", "kept_sha256")


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those that are not held out."""
    return pitman_yor.score(documents(spark, sf_dir))


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left in every document once strings of earlier documents are taken out."""
    cut = suffix_array.remove_repeats(documents(spark, sf_dir), kept=lambda text: F.sha2(text, 256))
    return cut.withColumnRenamed("kept_text", "kept_sha256")


def op10_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return simhash.near_groups(documents(spark, sf_dir))


def op11_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical.search(documents(spark, sf_dir), items)


def op12_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return personal.find(documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers cut every document, and how common its linked ids are."""
    return alignment.align(documents(spark, sf_dir), vocabulary_path(), public_tokenizers.path(PIECES))


def _op1_sql() -> str:
    """Scores of lines and windows and inheritance of `licenses` in SQL, from the same parameters.

    Runs of lines and paragraphs are left to the tests.
    """

    def literal(text: str) -> str:
        return "'{}'".format(text.replace("'", "''"))

    quoted = ", ".join(f"({literal(k)}, {literal(v)})" for k, v in licenses.TEMPLATES.items())
    listed = enumerate([(0, *x) for x in licenses.TEMPLATES.items()] + [(1, *x) for x in licenses.BLOCKS])
    every = ", ".join(f"({s}, {t}, {literal(k)}, {literal(v)})" for t, (s, k, v) in listed)
    size, speaks = len(licenses.TEMPLATES), licenses.SPEAKS.removeprefix("(?i)")
    rare = f"ln(1.0 + CASE s WHEN 0 THEN {size} ELSE {len(licenses.BLOCKS)} END)"
    tags = r"'SPDX-License-Identifier:[\x20\x09]*\(?', 'spdx-license-identifier-', 'gi'"
    square = licenses.WINDOW_THRESHOLD**2 - 1e-6
    return f"""
WITH templates(license, statement) AS (VALUES {quoted}),
tcount AS (
  SELECT license, term, count(*) AS tf FROM (
    SELECT license, unnest(regexp_extract_all(lower(statement), '{licenses.TERM}')) AS term FROM templates)
  GROUP BY ALL),
idfs AS (SELECT term, ln({size + 1}.0 / (1.0 + count(*))) + 1.0 AS idf FROM tcount GROUP BY term),
tweight AS (SELECT license, term, tf * idf AS weight FROM tcount JOIN idfs USING (term)),
tnorm AS (SELECT license, sqrt(sum(weight * weight)) AS norm FROM tweight GROUP BY license),
files AS (
  SELECT doc_id, coalesce(text, '') AS text,
         concat_ws('/', source, lang, (doc_id // 1000)::VARCHAR) AS dir FROM documents),
lines AS (
  SELECT doc_id, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n_words,
         unnest(string_split(text, chr(10))) AS said, unnest(range(len(string_split(text, chr(10))))) AS line
  FROM files),
own AS (
  SELECT *, len(regexp_extract_all(said, '[^\\x20\\x09-\\x0D]+')) AS n_said FROM lines
  WHERE regexp_matches(said, '{speaks}', 'i')),
lcount AS (
  SELECT doc_id, line, n_words, n_said, term, count(*) AS tf FROM (
    SELECT *, unnest(regexp_extract_all(lower(said), '{licenses.TERM}')) AS term FROM own)
  GROUP BY doc_id, line, n_words, n_said, term),
lweight AS (
  SELECT l.*, tf * coalesce(idf, ln({size + 1}.0 / 1.0) + 1.0) AS own FROM lcount l LEFT JOIN idfs USING (term)),
lnorm AS (SELECT doc_id, line, sqrt(sum(own * own)) AS own_norm FROM lweight GROUP BY doc_id, line),
scored AS (
  SELECT w.doc_id, w.license, 100 * any_value(n_said) // greatest(any_value(n_words), 1) AS share,
         round(sum(own * weight) / (any_value(norm) * any_value(own_norm)), {licenses.DIGITS}) AS score
  FROM (SELECT * FROM lweight JOIN tweight USING (term)) w JOIN lnorm USING (doc_id, line) JOIN tnorm USING (license)
  GROUP BY w.doc_id, line, w.license),
pieces(s, t, license, statement) AS (VALUES {every}),
pterms AS (
  SELECT s, t, license, unnest(regexp_extract_all(lower(
           CASE s WHEN 1 THEN regexp_replace(statement, {tags}) ELSE statement END), '{licenses.TERM}')) AS term
  FROM pieces),
pcount AS (SELECT s, t, license, term, count(*) AS tf FROM pterms GROUP BY ALL),
pidf AS (SELECT s, term, {rare} - ln(1.0 + count(*)) + 1.0 AS idf FROM pcount GROUP BY s, term),
pweight AS (
  SELECT s, t, license, term, idf, CASE s WHEN 1 THEN ln(tf) + 1.0 ELSE tf END * idf AS weight,
         sum(tf) OVER (PARTITION BY s, t)::BIGINT AS size FROM pcount JOIN pidf USING (s, term)),
pnorm AS (SELECT *, sqrt(sum(weight * weight) OVER (PARTITION BY s, t)) AS norm FROM pweight),
listed AS (
  SELECT s, doc_id, regexp_extract_all(lower(
           CASE s WHEN 1 THEN regexp_replace(text, {tags}) ELSE text END), '{licenses.TERM}') AS terms
  FROM files, (VALUES (0), (1)) AS sets(s)),
tokens AS (SELECT s, doc_id, unnest(terms) AS term, unnest(range(len(terms))) AS pos FROM listed),
hits AS (
  SELECT s, doc_id, t, pos, term, weight * weight / (norm * norm) AS part, size, greatest(size // 8, 1) AS step
  FROM tokens JOIN pnorm USING (s, term)),
-- By Cauchy and Schwarz a cosine is at most the root of the shared terms' part.
could AS (
  SELECT doc_id, t FROM (SELECT DISTINCT doc_id, t, term, part FROM hits) GROUP BY ALL HAVING sum(part) >= {square}),
covered AS (
  SELECT s, doc_id, t, size, step, term, part,
         unnest(range(greatest(ceil((pos - size + 1) / step), 0)::BIGINT, pos // step + 1)) AS k
  FROM hits JOIN could USING (doc_id, t)),
near_windows AS (
  SELECT s, doc_id, t, k * step AS start, size FROM (SELECT DISTINCT * FROM covered)
  GROUP BY ALL HAVING sum(part) >= {square}),
cut AS (
  SELECT w.*, len(terms) AS n_words, terms[start + 1 : start + size] AS said
  FROM near_windows w JOIN listed USING (s, doc_id)),
wcount AS (
  SELECT s, doc_id, t, start, any_value(n_words) AS n_words, any_value(n_said) AS n_said, term, count(*) AS tf
  FROM (SELECT *, len(said) AS n_said, unnest(said) AS term FROM cut) GROUP BY s, doc_id, t, start, term),
wweight AS (
  SELECT w.*, CASE s WHEN 1 THEN ln(tf) + 1.0 ELSE tf END * coalesce(idf, {rare} + 1.0) AS own
  FROM wcount w LEFT JOIN pidf USING (s, term)),
wscored AS (
  SELECT w.doc_id, any_value(license) AS license, 1 + w.s AS kind,
         100 * any_value(n_said) // greatest(any_value(n_words), 1) AS share,
         round(sum(own * weight) / (any_value(norm) * sqrt(sum(own * own) + any_value(rest))), {licenses.DIGITS}) AS score
  FROM (SELECT w.*, sum(CASE WHEN p.term IS NULL THEN own * own ELSE 0 END) OVER (
               PARTITION BY w.doc_id, w.t, w.start) AS rest, license, weight, norm
        FROM wweight w LEFT JOIN pnorm p ON w.s = p.s AND w.t = p.t AND w.term = p.term) w
  WHERE weight IS NOT NULL GROUP BY w.doc_id, w.s, w.t, w.start),
best AS (
  SELECT * FROM (
    SELECT doc_id, license, 0 AS kind, share, score FROM scored WHERE score >= {licenses.THRESHOLD}
    UNION ALL SELECT doc_id, license, kind, share, score FROM wscored WHERE score >= {licenses.WINDOW_THRESHOLD})
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license, kind, share DESC) = 1),
licensed AS (
  SELECT dir, arg_min(license, doc_id::VARCHAR) AS license FROM best JOIN files USING (doc_id)
  WHERE share >= {licenses.MOSTLY} GROUP BY dir),
near AS (
  SELECT doc_id, arg_max(l.dir, len(l.dir)) AS above, arg_max(l.license, len(l.dir)) AS inherited
  FROM files f JOIN licensed l ON f.dir = l.dir OR starts_with(f.dir, l.dir || '/') GROUP BY doc_id)
SELECT f.doc_id, b.license AS own_license, score, coalesce(b.license, inherited) AS license,
       CASE WHEN b.license IS NULL THEN above END AS license_dir
FROM files f LEFT JOIN best b ON f.doc_id = b.doc_id LEFT JOIN near n ON f.doc_id = n.doc_id
"""


def _op3_sql() -> str:
    """The rules of `quality` in SQL, from the same parameters."""
    rates = " UNION ALL ".join(
        f"SELECT *, '{name}' AS rate, {part} * {times} // greatest({whole}, 1) AS exact, {slack} AS slack FROM counts"
        for name, (part, whole, times, slack) in quality.RATES.items()
    )
    levels = " UNION ALL ".join(
        f"SELECT {i} AS level, {lang} AS l, {source} AS s, rate, slack, value FROM sketched"
        for i, (lang, source) in enumerate((("lang", "source"), ("lang", "NULL"), ("NULL", "NULL")))
    )
    return f"""
WITH base AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
tokens AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM base),
wins AS (
  SELECT doc_id, pos, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3,
         lead(w, 4) OVER o AS w4
  FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, w, w1, w2, w3, w4) AS n FROM wins WHERE w4 IS NOT NULL),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(pos, pos + {quality.WINDOW})) AS p FROM twice WHERE n > 1) GROUP BY doc_id),
counts AS (
  SELECT b.doc_id, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         len(ws) < {quality.MIN_WORDS}
           OR 100 * coalesce(c.n, 0) > {quality.MAX_REPEATED_PERCENT} * len(ws) AS base_failed
  FROM base b LEFT JOIN covered c ON b.doc_id = c.doc_id),
rated AS ({rates}),
sketched AS (
  SELECT *, (exact // (1 << greatest(length(bin(exact)) - 6, 0)))
            * (1 << greatest(length(bin(exact)) - 6, 0)) AS value
  FROM rated WHERE NOT base_failed),
levels AS ({levels}),
limits AS (
  SELECT level, l, s, rate, count(*) AS n,
         quantile_disc(value, 0.5) - {quality.SPREADS} * (quantile_disc(value, 0.5) - quantile_disc(value, 0.1))
           - max(slack) AS low,
         quantile_disc(value, 0.5) + {quality.SPREADS} * (quantile_disc(value, 0.9) - quantile_disc(value, 0.5))
           + max(slack) AS high
  FROM levels GROUP BY ALL),
chosen AS (
  SELECT r.doc_id, r.exact, arg_min(low, level) AS low, arg_min(high, level) AS high
  FROM rated r JOIN limits m ON r.rate = m.rate AND (m.level = 2 OR (m.n >= {quality.GROUP_ROWS} AND (
       (m.level = 0 AND m.l = r.lang AND m.s = r.source) OR (m.level = 1 AND m.l = r.lang))))
  GROUP BY r.doc_id, r.rate, r.exact),
verdict AS (SELECT doc_id, bool_and(exact BETWEEN low AND high) AS inside FROM chosen GROUP BY doc_id)
SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(inside, true) AS kept
FROM counts c LEFT JOIN verdict v ON c.doc_id = v.doc_id
"""


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP7_SQL = f"""
WITH base AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
starts AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - {substring_tree.WINDOW - 2})) AS p
  FROM base WHERE len(ws) >= {substring_tree.WINDOW}),
wins AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + {substring_tree.WINDOW - 1}], ' ')) AS k FROM starts),
later AS (
  SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM wins)
  WHERE r > 1),
gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT doc_id, unnest(range(p, p + {substring_tree.WINDOW})) AS p FROM later)),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM base),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT b.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM base b LEFT JOIN kept k ON b.doc_id = k.doc_id
"""

OP9_SQL = f"""
WITH base AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (
  SELECT doc_id, h, unnest(range(0, strlen(h) // 2 - {suffix_array.WINDOW - 1})) AS p
  FROM base WHERE strlen(h) >= {2 * suffix_array.WINDOW}),
wins AS (SELECT doc_id, p, md5(substring(h, 2 * p + 1, {2 * suffix_array.WINDOW})) AS k FROM starts),
later AS (SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS m FROM wins) WHERE m < doc_id),
spans AS (
  SELECT doc_id, min(p) AS a, max(p) + {suffix_array.WINDOW} AS b FROM (
    SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (
      SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {suffix_array.WINDOW}
                             THEN 0 ELSE 1 END AS fresh FROM later))
  GROUP BY doc_id, run),
stays AS (
  SELECT s.doc_id, substring(h, 2 * coalesce(lag(s.b) OVER o, 0) + 1, 2 * (a - coalesce(lag(s.b) OVER o, 0))) AS t,
         a, s.b - a AS n, s.b AS e
  FROM spans s JOIN base USING (doc_id) WINDOW o AS (PARTITION BY s.doc_id ORDER BY a)),
summed AS (
  SELECT doc_id, string_agg(t, '' ORDER BY a) AS t, sum(n) AS n, count(*) AS c, max(e) AS e FROM stays GROUP BY doc_id)
SELECT base.doc_id, strlen(h) // 2 AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(c, 0) AS n_spans,
       sha256(unhex(coalesce(t || substring(h, 2 * e + 1), h))) AS kept_sha256
FROM base LEFT JOIN summed ON base.doc_id = summed.doc_id
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "".join(map(chr, range(65, 91)))
OP11_SQL = f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{TERM}') AS ts
  FROM documents),
held AS (SELECT r, unnest(ts) AS term FROM docs),
counted AS (SELECT r, term, count(*) AS tf FROM held GROUP BY r, term),
sums AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM docs),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, sums GROUP BY term, n_docs),
lengths AS (SELECT r, doc_id, 100 - 75 + (75 * len(ts) * n_docs) // n_terms AS m FROM docs, sums),
asked AS (
  SELECT q, item_id, term, count(*) AS times FROM (
    SELECT item_id, row_number() OVER () AS q,
           unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{TERM}')) AS term
    FROM benchmark) GROUP BY q, item_id, term),
scored AS (
  SELECT q, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN lengths USING (r)
  GROUP BY q, item_id, r, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {lexical.MOST}
"""

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_orc": op4_token_orc,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_substring_tree": op7_substring_tree,
    "op8_pitman_yor": op8_pitman_yor,
    "op9_suffix_array": op9_suffix_array,
    "op10_simhash_bktree": op10_simhash_bktree,
    "op11_block_search": op11_block_search,
    "op12_weak_supervision": op12_weak_supervision,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES = {
    "op1_license_scan": _op1_sql(),
    "op3_quality_rules": _op3_sql(),
    "op6_exact_dedup": OP6_SQL,
    "op7_substring_tree": OP7_SQL,
    "op9_suffix_array": OP9_SQL,
    "op11_block_search": OP11_SQL,
}
