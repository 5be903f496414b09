"""Cluster, pressure-factor and natural-language queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.catalog.inputs import Inputs, Query, over
from wardlens.plans import cluster, gold, questions
from wardlens.session import cut_lineage
from wardlens.sources import driver_tables

# The mapped hospitals have 0 to 12 beds, so the size groups are cut there.
SIZES = [(3, "PEQUENO"), (6, "MEDIO"), (9, "GRANDE")]


def _by_size(i: Inputs) -> DataFrame:
    return i.features.withColumn("porte", cluster.size_group(F.col("leitos_sus"), SIZES))


def _size_groups(i: Inputs) -> DataFrame:
    return _by_size(i).select("co_cnes", "leitos_sus", "porte")


def _elbow(i: Inputs) -> DataFrame:
    return cluster.elbow(cluster.scaled_features(i.features)).table(i.features)


def _fits(i: Inputs) -> tuple[DataFrame, cluster.Elbow]:
    features = cut_lineage(i.features)
    return features, cluster.elbow(cluster.scaled_features(features))


def _clusters(i: Inputs) -> DataFrame:
    fits = _fits(i)[1]
    return fits.assign(fits.best_k())


def _assignment(i: Inputs) -> DataFrame:
    fits = _fits(i)[1]
    return cluster.assignment_check(fits, fits.best_k())


def _costs(i: Inputs) -> DataFrame:
    return cluster.cost_check(_fits(i)[1])


def _factors_by_label(i: Inputs) -> DataFrame:
    """Pressure factors over groups that no fit decides: the labels of the vectors, four of their entries."""
    vectors = driver_tables.table(i.spark, i.sf_dir, "embeddings")
    entry = [F.floor(F.col("embedding")[k].cast("double") * 1000).cast("decimal(18,2)") for k in range(4)]
    members = vectors.select(
        F.col("vec_id").cast("string").alias("co_cnes"), "label", *[e.alias(c) for e, c in zip(entry, cluster.FACTORS.values())]
    )
    return cluster.pressure_factors(members, "label")


def _factors(i: Inputs) -> DataFrame:
    features, fits = _fits(i)
    return cluster.pressure_factors(features.join(fits.assign(fits.best_k()), "co_cnes"), "cluster")


def _responses(i: Inputs) -> DataFrame:
    """One model response per turn: a thought, then the text where the assistant speaks."""
    thought = F.struct(F.concat(F.lit("papel: "), "role").alias("text"), F.lit(True).alias("thought"))
    spoken = F.struct(F.col("text").alias("text"), F.lit(None).cast("boolean").alias("thought"))
    parts = F.when(F.col("role") == "assistant", F.array(thought, spoken)).otherwise(
        F.array(thought)
    )
    content = F.struct(parts.alias("parts"), F.lit("model").alias("role"))
    body = F.struct(F.array(F.struct(content.alias("content"))).alias("candidates"))
    return i.conversations.select("conv_id", "turn", F.to_json(body).alias("resposta"))


def _answers(i: Inputs) -> DataFrame:
    return _responses(i).select(
        "conv_id", "turn", questions.answer_text(F.col("resposta")).alias("texto")
    )


def _prompts(i: Inputs) -> DataFrame:
    asked = i.conversations.where(F.col("role") == "user").select("conv_id", "turn", "text")
    view = gold.with_meanings(gold.monthly_occupancy(i.occupancy)).schema
    return questions.with_prompts(asked, "text", questions.describe("gld_ocupacao_mensal", view))


def _bodies(i: Inputs) -> DataFrame:
    """The prompt read back out of the JSON request body."""
    text = F.get_json_object("corpo", "$.contents[0].parts[0].text")
    return _prompts(i).select("conv_id", "turn", text.alias("prompt"))


ANALYTICS: dict[str, Query] = {
    "m1_m4_kmeans": over(_clusters),
    "m2_scaled_features": over(lambda i: cluster.scaled_columns(cluster.scaled_features(i.features))),
    "m3_elbow": over(_elbow),
    "m3_cost_check": over(_costs),
    "m4_assignment_check": over(_assignment),
    "m5_zscores_by_size": over(lambda i: cluster.pressure_factors(_by_size(i), "porte")),
    "m6_size_groups": over(_size_groups),
    "d26_gld_fatores_hospital": over(_factors),
    "d26_factors_by_label": over(_factors_by_label),
    "x20_request_body": over(_bodies),
    "x21_answer_text": over(_answers),
    "x22_prompts": over(lambda i: _prompts(i).select("conv_id", "turn", "prompt")),
}
