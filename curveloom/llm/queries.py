"""The queries of this subpackage, each over its whole table, ``(spark, folder) -> DataFrame``, and SQL for them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curveloom.llm import (alignment, ann, decontam, licences, negatives, packing, pii, quality, rules, rules_sql, secrets,
                           simhash, spans, substrings, toxicity)
from curveloom.llm.common import read, written


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer's vocabulary, which is installed on all machines."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every row; missing and empty texts are judged by the scorer's bias, and equal texts get equal results."""
    found = quality.scored(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "posterior", "score", "rejected")


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every row; missing and empty texts get the score of no evidence, and equal texts get equal scores."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    lexicon = toxicity.learned(docs, read(spark, folder, "labels"))
    found = toxicity.scored(docs, lexicon, 0.7)
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every row; texts without words have fingerprint zero, and a component without any id has a missing one."""
    found = simhash.near_duplicates(read(spark, folder, "documents"), words=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_private(spark: SparkSession, folder: str) -> DataFrame:
    """Every row; missing and empty texts have no spans. Of spans that start together the kind listed first comes first."""
    found = pii.found(read(spark, folder, "documents").select("doc_id", "text"))
    base = F.sha2(spans.joined(F.col("base")).cast("binary"), 256)
    return found.select("doc_id", *spans.counts("base", pii.KINDS), base.alias("base_sha256"), spans.joined(F.col("spans")).alias("spans"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each document and item found in it, at its best place, of equal ones the first; repeated rows give repeated results."""
    return decontam.leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Every row; missing and empty texts have no spans. Of spans that start together the kind listed first comes first."""
    found = secrets.found(read(spark, folder, "documents").select("doc_id", "text"))
    base = F.sha2(spans.joined(spans.of_kinds("spans", secrets.BASE_KINDS)).cast("binary"), 256)
    return found.select("doc_id", *spans.counts("spans", secrets.BASE_KINDS), base.alias("base_sha256"),
                        spans.joined(F.col("spans")).alias("spans"))


def op7_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as files by host and path; a page with a licence speaks for its directory."""
    pages = read(spark, folder, "pages").select("page_id", "url", "html")
    found = licences.licences(pages, licences.page_path(F.col("url")), licences.page_lines(F.col("html")), F.lit(True))
    return found.select("page_id", "licence", "similarity", "licence_from")


def op8_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Every row; missing and empty texts have no words. Rows without an id count as one document, so what they share stays."""
    found = substrings.kept(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Ties go to the smaller id; rows that can't be compared take no part, and an empty table gives an empty one."""
    return ann.search(read(spark, folder, "embeddings"), every_nth=50, k=5)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every row; a missing or empty text is its end mark alone, and repeated rows are packed again."""
    return packing.packed(read(spark, folder, "documents"), vocabulary())


def op11_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The measures are kept as a table, a hundred bytes a document, for the estimation and for the verdicts."""
    found = written(rules.measured(read(spark, folder, "documents").select("doc_id", "text")).drop("text"), "measures")
    verdicts = rules.judged(found, rules.posteriors(found))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                           F.round("posterior", 6).alias("posterior"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every row; missing, empty and misspelled texts have zeros, and repeated rows count each time."""
    found = alignment.aligned(read(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Ties go to the smaller id; rows that can't be scored take no part, and an empty table gives an empty one."""
    return negatives.mined(read(spark, folder, "embeddings"), every_nth=50, positives=5, negatives=3)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_toxicity": op2_toxicity,
    "op3_simhash": op3_simhash,
    "op4_private": op4_private,
    "op5_decontamination": op5_decontamination,
    "op6_secrets": op6_secrets,
    "op7_licences": op7_licences,
    "op8_substrings": op8_substrings,
    "op9_neighbours": op9_neighbours,
    "op10_packing": op10_packing,
    "op11_rules": op11_rules,
    "op12_alignment": op12_alignment,
    "op13_negatives": op13_negatives,
}

_TEMPLATES = ", ".join(f"({n}, '{licence}', '{text}')" for n, (licence, text) in enumerate(licences.TEMPLATES))

SQL: dict[str, str] = {
    "op11_rules": rules_sql.sql(),
    "op7_licences": f"""
WITH files AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://', ''),
           '[?#].*$', '', 's'), '^([^/]+)$', '\\1/') AS path, coalesce(html, '') AS html FROM pages),
placed AS (SELECT *, regexp_replace(path, '/?[^/]*$', '') AS folder FROM files),
split_lines AS (SELECT page_id, unnest(list) AS line, generate_subscripts(list, 1) AS place FROM (
  SELECT page_id, string_split(regexp_replace(html, '<[^<>]*>', chr(10), 'g'), chr(10)) AS list FROM placed)),
lines AS MATERIALIZED (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY place) AS place, terms FROM (
  SELECT page_id, place, regexp_extract_all(lower(line), '[a-z0-9]+') AS terms FROM split_lines) WHERE len(terms) > 0),
totals AS (SELECT count(*) AS n FROM lines),
idf AS MATERIALIZED (SELECT term, ln((1 + (SELECT n FROM totals)) / (1 + count(*))) + 1 AS idf FROM (
  SELECT DISTINCT page_id, place, term FROM (SELECT page_id, place, unnest(terms) AS term FROM lines)) GROUP BY term),
passages AS MATERIALIZED (SELECT row_number() OVER () AS line, page_id, terms FROM (
  SELECT page_id, terms FROM lines
  {"".join(f"""UNION ALL SELECT page_id, terms FROM (SELECT page_id, {" || ".join(["terms", *[f"lead(terms, {k}) OVER w" for k in range(1, n)]])} AS terms
    FROM lines WINDOW w AS (PARTITION BY page_id ORDER BY place)) WHERE terms IS NOT NULL
  """ for n in range(2, licences.PASSAGE + 1))})),
templates(template, licence, said) AS (VALUES {_TEMPLATES}),
template_terms AS (SELECT template, licence, term, count(*) AS tf FROM (
  SELECT template, licence, unnest(regexp_extract_all(lower(said), '[a-z0-9]+')) AS term FROM templates) GROUP BY ALL),
vectors AS MATERIALIZED (SELECT template, licence, term, tf * coalesce(idf, ln(1 + (SELECT n FROM totals)) + 1) AS weight
  FROM template_terms LEFT JOIN idf USING (term)),
held AS MATERIALIZED (SELECT line, term, tf * idf AS held FROM (
  SELECT line, term, count(*) AS tf FROM (SELECT line, unnest(terms) AS term FROM passages) GROUP BY ALL) JOIN idf USING (term)),
sizes AS (SELECT line, sqrt(sum(held * held)) AS size FROM held GROUP BY line),
norms AS (SELECT template, licence, sqrt(sum(weight * weight)) AS length FROM vectors GROUP BY ALL),
cosines AS (SELECT line, licence, round(sum(held * weight) / (any_value(length) * any_value(size)), {licences.DIGITS}) AS similarity
  FROM held JOIN vectors USING (term) JOIN norms USING (template, licence) JOIN sizes USING (line) GROUP BY line, template, licence),
own AS (SELECT DISTINCT ON (page_id) page_id, licence, similarity FROM cosines JOIN passages USING (line)
  WHERE similarity >= {licences.LEAST} ORDER BY page_id, similarity DESC, licence),
notices AS (SELECT DISTINCT ON (folder) folder, path, licence FROM own JOIN placed USING (page_id)
  ORDER BY folder, similarity DESC, path, licence),
nearest AS (SELECT DISTINCT ON (page_id) page_id, n.licence, n.path FROM placed p JOIN notices n
  ON p.folder = n.folder OR starts_with(p.folder, n.folder || '/') OR n.folder = ''
  ORDER BY page_id, len(string_split(n.folder, '/')) DESC, len(n.folder) DESC)
SELECT page_id, coalesce(o.licence, n.licence) AS licence, o.similarity,
  CASE WHEN o.licence IS NOT NULL THEN p.path ELSE n.path END AS licence_from
FROM placed p LEFT JOIN own o USING (page_id) LEFT JOIN nearest n USING (page_id)
""",
}
