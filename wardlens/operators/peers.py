"""How each member of a group stands against the group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.operators.broadcasting import checked_broadcast


def _hundredths(name: str) -> str:
    return f"cast({name} * 100 as bigint)"


def peer_zscores(df: DataFrame, group: str, factors: dict[str, str]) -> DataFrame:
    """Adds `z_<factor>`: (x - mean) / sample deviation within the group, four decimals.

    A window over the group would put a whole cluster, perhaps a third of all hospitals, in
    one task. The groups are folded to exact integer moments instead (map-side), and that
    small table is joined back.
    """
    moments = []
    for factor, column in factors.items():
        x = F.expr(_hundredths(column))
        moments += [
            F.count(x).alias(f"n_{factor}"),
            F.sum(x.cast("decimal(19,0)")).alias(f"s_{factor}"),
            F.sum((x.cast("decimal(19,0)") * x).cast("decimal(28,0)")).alias(f"q_{factor}"),
        ]
    stats = checked_broadcast(df.groupBy(group).agg(*moments))
    scores = [F.expr(f"{_zscore(f, c)} as z_{f}") for f, c in factors.items()]
    return df.join(stats, group, "left").select(*df.columns, *scores)


def _zscore(factor: str, column: str) -> str:
    n, s, q = f"n_{factor}", f"s_{factor}", f"q_{factor}"
    spread = f"cast(cast({n} * {q} - {s} * {s} as decimal(38,0)) as double)"
    width = f"sqrt(cast({n} as double) * {spread} / nullif({n} - 1, 0))"
    distance = f"cast({n} * {_hundredths(column)} - {s} as double)"
    return f"floor({distance} / nullif({width}, 0) * 10000 + 0.5D) / 10000D"


def dominant_factor(df: DataFrame, factors: list[str], name: str = "fator_dominante") -> DataFrame:
    """The factor with the largest z-score; the first listed wins a tie, none gives NULL."""
    largest = F.greatest(*[F.col(f"z_{f}") for f in factors])
    chain = F
    for factor in factors:
        chain = chain.when(F.col(f"z_{factor}") == largest, factor)
    return df.withColumn(name, chain)
