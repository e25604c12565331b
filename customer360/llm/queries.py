"""Registered queries of the pipeline operators: thin digests of their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from customer360.llm import exactdedup, lexical, licenses, merkle


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(n: int) -> F.Column:
    """crc32 of doc_id as text, modulo n: the folds of the contracts."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the rows not held out."""
    from customer360.llm.nbsvm import fit_quality, score_quality

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = score_quality(docs, fit_quality(docs, labels.where(_remainder(3) != 1)))
    return scored.select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own or inherited licence of every document. The table has no paths, so a
    file stands at /<source>/<thousands of doc_id>/<hundreds>/<doc_id>.txt, and
    a document that opens with a licence line is its directory's licence file."""
    from customer360.llm.licenses import scan_licenses

    folder = [(F.floor(F.col("doc_id") / n)).cast("string") for n in (1000, 100)]
    path = F.concat(F.lit("/"), F.col("source"), F.lit("/"), folder[0], F.lit("/"), folder[1], F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    files = _table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return scan_licenses(files, first_line_files=True)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every verified benchmark passage of ``documents``."""
    from customer360.llm.decontam import find_leaks

    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines' classes and the lines that go."""
    from customer360.llm.linededup import line_report

    return line_report(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the rows not held out."""
    from customer360.llm.toxcnn import toxicity

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = toxicity(docs, docs, labels.where(_remainder(5) != 0))
    return scored.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the rows not held out."""
    from customer360.llm.langid import fit_languages, identify

    docs = _table(spark, sf_dir, "documents")
    found = identify(docs, fit_languages(docs.where(_remainder(4) != 2)))
    return found.select("doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from customer360.llm.htmltext import extract_pages

    return extract_pages(_table(spark, sf_dir, "pages"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit-embedding fingerprints of every document and of its edited text."""
    from customer360.llm.editembed import fingerprint_report

    return fingerprint_report(_table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    from customer360.llm.ngramjoin import link_components

    return link_components(_table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token piece with its place in a packed sequence."""
    from customer360.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document, copies and single ones alike."""
    from customer360.llm.exactdedup import copy_groups

    # The digest of every text is part of the result, so here all are read to the end.
    return copy_groups(_table(spark, sf_dir, "documents"), digest_all=True).withColumnRenamed("digest", "text_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and the check of a partly changed copy of every document."""
    from customer360.llm.merkle import manifest_report

    return manifest_report(_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    from customer360.llm.lexical import search

    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (op1_quality, op2_license_scan, op3_decontamination, op4_line_dedup, op5_language_id, op6_html_text, op7_fingerprints, op8_ngram_jaccard, op9_best_fit_packing, op10_toxicity, op11_exact_dedup, op12_merkle_manifest, op13_ranked_search)
}
ORACLE_SQL = {
    "op11_exact_dedup": exactdedup.ORACLE,
    "op12_merkle_manifest": merkle.oracle(),
    "op13_ranked_search": lexical.ORACLE,
    "op2_license_scan": licenses.oracle(
        "SELECT doc_id, '/' || source || '/' || (doc_id // 1000) || '/' || (doc_id // 100) || '/' || doc_id || '.txt' AS path, text FROM documents"),
}
