"""Registered queries that write a table by a sink and read it by a source, each with SQL over the table itself."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators import ontology
from caseloom.plans.queries import _distinct, query
from caseloom.session import shared_dir, table
from caseloom.sources import catalog, files


def _place(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


@query("SELECT DISTINCT image_id, CASE WHEN caption = '' THEN NULL ELSE caption END AS caption, license FROM selected_images")
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A table through CSV with quotes and line breaks; an empty field is null there."""
    path = _place(spark, "csv")
    files.write_csv(_distinct(spark, d, "selected_images", "image_id", "caption", "license"), path)
    return files.read_csv(spark, path, "image_id string, caption string, license string")


@query("SELECT DISTINCT request_sha256, case_id, decision, evidence_start, processing_status FROM medgemma_labels")
def jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A table through JSON lines with nulls kept and field names checked."""
    path = _place(spark, "jsonl")
    files.write_jsonl(_distinct(spark, d, "medgemma_labels", "request_sha256", "case_id", "decision", "evidence_start", "processing_status"), path)
    back = files.read_jsonl(spark, path, "request_sha256 string, case_id string, decision string, evidence_start int, processing_status string")
    return back.where("problem is null").drop("problem")


@query("SELECT DISTINCT case_id, article_id, age FROM cases")
def catalog_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A table through the catalog: written twice by rename, read by columns with its declared schema."""
    c = catalog.Catalog(spark, _place(spark, "catalog"), {"data/cases": "case_id string, article_id string, age double, gender string"})
    c.write("data/cases", _distinct(spark, d, "cases", "case_id", "article_id", "age", "gender").limit(0))
    c.write("data/cases", _distinct(spark, d, "cases", "case_id", "article_id", "age", "gender"))
    return c.read("data/cases", ["case_id", "article_id", "age"]).distinct()


@query("""SELECT upper(trim(diagnosis_label)) AS concept_id, min(disease) AS disease, string_agg(DISTINCT disease, ';' ORDER BY disease) AS aliases FROM manifest WHERE trim(disease) <> '' AND regexp_matches(upper(trim(diagnosis_label)), '^\\w+:\\d+$') GROUP BY 1""")
def obo_terms(spark: SparkSession, d: str) -> DataFrame:
    """An ontology file of the labels and their names, written and parsed; obsolete terms and other blocks are left out."""
    t = table(spark, d, "manifest").where("trim(disease) <> ''").groupBy(F.upper(F.trim("diagnosis_label")).alias("c")).agg(F.array_sort(F.collect_set("disease")).alias("names")).where(r"c rlike '^\\w+:\\d+$'")
    synonyms = F.array_join(F.transform("names", lambda n: F.concat(F.lit('synonym: "'), n, F.lit('" EXACT []\n'))), "")
    term = F.concat(F.lit("[Term]\nid: "), "c", F.lit("\nname: "), F.get("names", F.lit(0)), F.lit("\n"), synonyms, F.lit("is_a: IDX:0 ! root\n"))
    gone = F.concat(F.lit("\n[Term]\nid: OLD:1\nname: gone\nis_obsolete: true\n\n[Typedef]\nid: part_of\n"))
    path = _place(spark, "obo")
    t.select(F.concat(term, gone)).coalesce(1).write.text(path)
    out = ontology.read_obo(spark, path)
    return out.select("concept_id", "disease", F.array_join("aliases", ";").alias("aliases"))


@query("SELECT 'cases.csv' AS name, (SELECT count(DISTINCT case_id) FROM cases) AS n, true AS verified")
def checksum_scan(spark: SparkSession, d: str) -> DataFrame:
    """Files written, locked by size and digest, and verified: how many rows they hold and whether the lock holds."""
    path = _place(spark, "locked")
    _distinct(spark, d, "cases", "case_id").write.option("header", False).csv(path)
    found = catalog.checksums(spark, path, "*.csv")
    broken = catalog.verify_files(catalog.checksums(spark, path, "*.csv"), found).agg(F.count("*").alias("bad"))
    lines = spark.read.csv(path, schema="case_id string").agg(F.count("*").alias("n"))
    return lines.crossJoin(broken).select(F.lit("cases.csv").alias("name"), "n", (F.col("bad") == 0).alias("verified"))  # one row each
