"""Source records to the normalized tables, as one lazy plan a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import strip
from caseloom.operators.normalize import duplicate_keys, field, flatten_records, image_path, orphans, require_empty, split_accepted


def articles(metadata: DataFrame) -> DataFrame:
    """One row per article with defaults for what is missing, and the whole record as JSON."""
    flat = flatten_records(metadata, "article_metadata", ["article_id"])
    every = F.to_json(F.struct(*sorted(flat.columns)), {"ignoreNullFields": "false"})
    pick = lambda *names: field(flat, *names)
    return flat.select(
        pick("article_id", "pmcid").cast("string").alias("article_id"), F.coalesce(pick("title").cast("string"), F.lit("")).alias("title"),
        F.coalesce(pick("license").cast("string"), F.lit("")).alias("license"), F.coalesce(pick("link", "url").cast("string"), F.lit("")).alias("source_url"),
        F.coalesce(pick("year").cast("int"), F.lit(None).cast("int")).alias("year"), every.alias("metadata_json"),
    )


def cases(records: DataFrame, known: DataFrame) -> DataFrame:
    """One row per case with its article, text and digest; a missing article id is the first part of the case id."""
    flat = flatten_records(records, "cases", ["article_id"])
    article = F.coalesce(field(flat, "article_id").cast("string"), F.split_part(F.col("case_id"), F.lit("_"), F.lit(1)))
    out = flat.select("case_id", article.alias("article_id"), field(flat, "case_text", "raw_case_text").cast("string").alias("raw_case_text"), field(flat, "age").cast("double").alias("age"), field(flat, "gender").cast("string").alias("gender"))
    out = out.withColumn("raw_text_sha256", F.sha2("raw_case_text", 256))
    require_empty(duplicate_keys(out, "case_id"), "repeated or missing case ids")
    require_empty(orphans(out, known, "article_id"), "cases without an article")
    require_empty(out.where("raw_case_text is null"), "cases without a text")
    return out


def image_relations(records: DataFrame) -> DataFrame:
    """(main_image, case_id) of the images nested in case records, each pair once."""
    two = flatten_records(flatten_records(records, "case_images", ["article_id"]), "case_image_list", ["case_id"])
    return two.select(field(two, "main_image", "image_id").alias("main_image"), "case_id").where("main_image is not null").distinct()


def images(captions: DataFrame, known_cases: DataFrame, relations: DataFrame, articles_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted images and rejected ones, of one pass over the captions.

    An image is accepted if its case is known and the case record names it. Licence and path come from
    the caption row, else from the article and the file name.
    """
    rows = captions.select("image_id", "main_image", "case_id", "article_id", "caption", "license", "file")
    split = split_accepted(rows, known_cases, relations, "case_id", ["main_image", "case_id"])
    good = split.where("reject_reason is null").join(articles_.select("article_id", F.col("license").alias("__l")), "article_id", "left")
    licence = F.coalesce(F.nullif(strip(F.col("license")), F.lit("")), F.col("__l"), F.lit(""))
    accepted = good.select("image_id", "case_id", "article_id", F.coalesce("caption", F.lit("")).alias("caption"), image_path(F.col("file")).alias("path"), licence.alias("license"))
    require_empty(duplicate_keys(accepted, "image_id"), "repeated image ids")
    return accepted, split.where("reject_reason is not null").select("image_id", "case_id", "reject_reason")
