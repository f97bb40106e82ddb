"""Products from repository JSON and model addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.text import blank_to_null, strip
from recordmill.functions.times import iso_date
from recordmill.schemas import REPO
from recordmill.sources.envelope import envelope, first_given


def _content(
    product: Column, startup: Column, description: Column, category: str, launched: Column
) -> Column:
    return F.struct(
        product.alias("productName"),
        startup.alias("startupName"),
        F.lit("FREE").alias("pricingModel"),
        description.alias("description"),
        F.lit(category).alias("category"),
        launched.alias("launchDate"),
    )


def repo_json_products(df: DataFrame, collected_at: Column) -> DataFrame:
    repo = df.withColumn("_repo", F.from_json("raw_content", REPO))
    name = F.coalesce(first_given(F.col("_repo.name")), F.substring_index("url", "/", -1))
    created = F.col("_repo.created_at")
    launched = F.when(created.rlike(r"^\d{4}-\d{2}-\d{2}"), iso_date(created))
    launched = F.when(launched.rlike("Z$"), launched)
    content = _content(
        strip(name),
        strip(F.coalesce(first_given(F.col("_repo.owner.login")), F.lit("Independent"))),
        F.coalesce(
            blank_to_null(strip(F.col("_repo.description"))),
            strip(F.concat(name, F.lit(" software product"))),
        ),
        "AI Framework & Software Tool",
        launched,
    )
    url = F.coalesce(first_given(F.col("_repo.html_url")), F.col("url"))
    return envelope(repo, "PRODUCT", F.lit("GitHub Repositories"), url, content, collected_at)


def model_parts(url: Column) -> dict[str, Column]:
    """Owner and model from a model page address."""
    model = F.replace(url, F.lit("https://huggingface.co/"), F.lit(""))
    parts = F.split(model, "/")
    owned = F.size(parts) > 1
    return {
        "model": model,
        "startup": F.when(owned, F.get(parts, 0)).otherwise(F.lit("Community")),
        "product": F.when(owned, F.get(parts, 1)).otherwise(model),
    }


def model_id_products(df: DataFrame, collected_at: Column) -> DataFrame:
    parts = model_parts(F.col("url"))
    content = _content(
        parts["product"], parts["startup"],
        F.concat(parts["model"], F.lit(" AI model product hosted on Hugging Face")),
        "AI Machine Learning Model", F.lit(None).cast("string"),
    )
    return envelope(df, "PRODUCT", F.lit("Hugging Face Models"), F.col("url"), content, collected_at)
