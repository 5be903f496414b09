"""The table side of questions in natural language: prompts out, answers back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.plans.gold import VIEWS

INTRO = "You translate questions about hospital beds into one Spark SQL SELECT. "
FORM = "Reply with that statement alone. Compare months as text; the newest is max(competencia). "
ANSWER = T.StructType().add(
    "candidates",
    T.ArrayType(
        T.StructType().add(
            "content",
            T.StructType().add(
                "parts",
                T.ArrayType(T.StructType().add("text", T.StringType()).add("thought", T.BooleanType())),
            ),
        )
    ),
)


def describe(name: str, schema: T.StructType) -> str:
    """What a model must know of a view: each column's name, type and, where it has one, comment."""
    columns = [
        f"{f.name} {f.dataType.simpleString()}" + (f" ({f.metadata['comment']})" if "comment" in f.metadata else "")
        for f in schema
    ]
    return f"View {name}: {'; '.join(columns)}. "


def describe_views(spark: SparkSession, database: str) -> str:
    """The gold views a database has, as the catalog knows them."""
    there = [v for v in VIEWS if spark.catalog.tableExists(f"{database}.{v}")]
    return "".join(describe(v, spark.table(f"{database}.{v}").schema) for v in there)


def prompt(question: Column, schema_text: str) -> Column:
    return F.concat(F.lit(f"{INTRO}{schema_text}{FORM}Question: "), question)


def request_body(text: Column) -> Column:
    """The JSON request around a prompt; the JSON writer does the escaping."""
    part = F.struct(text.alias("text"))
    return F.to_json(F.struct(F.array(F.struct(F.array(part).alias("parts"))).alias("contents")))


def answer_text(response: Column) -> Column:
    """Text of the first part of the first candidate that is not a thought; else NULL."""
    parts = F.from_json(response, ANSWER)["candidates"]
    first = F.get(parts, F.lit(0))["content"]["parts"]
    spoken = F.filter(first, lambda p: ~F.coalesce(p["thought"], F.lit(False)))
    return F.get(spoken, F.lit(0))["text"]


def with_prompts(questions: DataFrame, column: str, schema_text: str) -> DataFrame:
    """Prompts, and request bodies around them, of questions over the views that `schema_text` describes."""
    text = prompt(F.col(column), schema_text)
    return questions.withColumn("prompt", text).withColumn("corpo", request_body(F.col("prompt")))
