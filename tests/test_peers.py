"""Peers, clusters, ranks and the disease join against brute force."""

import math
import statistics
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_traps import occupancy
from wardlens.operators.broadcasting import checked_broadcast
from wardlens.operators.peers import dominant_factor, peer_zscores
from wardlens.plans import clinical, cluster, gold, questions


def test_ranks_equal_a_plain_window_with_a_hot_rate(spark):
    # A third of all rows share one rate, and another part has none.
    data = [
        (
            f"{i:07d}",
            f"20240{i % 3 + 1}",
            None if i % 13 == 0 else 853 if i % 3 == 0 else (i * 37) % 400,
        )
        for i in range(3000)
    ]
    o = occupancy(spark, data)
    got = {(r.co_cnes, r.competencia): r.ranking_no_mes for r in gold.monthly_occupancy(o).collect()}
    months = defaultdict(list)
    for _, month, rate in data:
        months[month].append(math.inf if rate is None else rate)
    for hospital, month, rate in data:
        value = math.inf if rate is None else rate
        assert got[hospital, month] == 1 + sum(r > value for r in months[month])


def test_top_of_latest_equals_the_view(spark, inputs):
    view = gold.monthly_occupancy(inputs.occupancy)
    newest = view.agg(F.max("competencia")).first()[0]
    columns = ["co_cnes", "nome_estabelecimento", "ranking_no_mes", "taxa_ocupacao"]
    columns += ["var_vs_mes_anterior", "media_movel_3m"]
    for n in (1, 4, 50):
        expected = (
            view.where(F.col("competencia") == newest)
            .orderBy("ranking_no_mes", "co_cnes", "nome_estabelecimento")
            .limit(n)
        )
        assert rows(gold.top_of_latest(inputs.occupancy, n).select(columns)) == rows(
            expected.select(columns)
        )


def test_zscores_equal_plain_statistics(spark):
    data = [(f"h{i}", "A" if i % 3 else "B", Decimal(i * i % 97) / 10, i % 7) for i in range(40)]
    data += [("solo", "C", Decimal("1.0"), 1), ("vazio", "A", None, None)]
    df = spark.createDataFrame(data, "co_cnes string, g string, a decimal(18,1), b int")
    got = {
        r.co_cnes: r
        for r in dominant_factor(
            peer_zscores(df, "g", {"fa": "a", "fb": "b"}), ["fa", "fb"]
        ).collect()
    }
    for key, group, a, b in data[:40]:
        peers = [d for d in data if d[1] == group and d[2] is not None]
        scores = {}
        for name, value, column in (("fa", a, 2), ("fb", b, 3)):
            values = [float(p[column]) for p in peers]
            scores[name] = (float(value) - statistics.mean(values)) / statistics.stdev(values)
            assert abs(getattr(got[key], f"z_{name}") - scores[name]) < 1e-4
        assert got[key].fator_dominante == max(scores, key=scores.get)
    assert (got["solo"].z_fa, got["solo"].fator_dominante) == (None, None)
    assert (got["vazio"].z_fa, got["vazio"].fator_dominante) == (None, None)


def test_broadcast_only_below_the_limit(spark):
    big, small = spark.range(50), spark.range(5)
    key = lambda df: df.groupBy("id").count()
    plan = lambda side: big.join(side, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(checked_broadcast(key(small), 10))
    assert "strategy=broadcast" not in plan(checked_broadcast(key(big), 10))


def test_disease_ranges_equal_between(spark):
    codes = ["A000", "B99", "B99X", "C00", "D48Z", "D49", "S12", "T98", "T99", "a00", "Z9", None, ""]
    chapters = [("I", "A00", "B99"), ("II", "C00", "D48"), ("XIX", "S00", "T98"), ("XXI", "Z00", "Z99")]
    c = spark.createDataFrame([(x, x) for x in codes], "subcat string, descricao string")
    k = spark.createDataFrame([(*x, x[0]) for x in chapters], "numcap string, catinic string, catfim string, descricao string")
    got = {(r.codigo, r.capitulo) for r in clinical.disease_dimension(c, k).collect()}
    assert got == {
        (x, n) for x in codes if x for n, first, last in chapters if first <= x[:3] <= last
    }


def test_three_character_diagnoses_find_their_chapter(spark):
    dim = spark.createDataFrame(
        [("A000", "d", "I", "c"), ("A001", "d", "I", "c"), ("B99", "d", "I", "c")],
        "codigo string, descricao string, capitulo string, ds_capitulo string",
    )
    assert sorted(rows(clinical.chapter_lookup(dim))) == [
        ("A00", "I"),
        ("A000", "I"),
        ("A001", "I"),
        ("B99", "I"),
    ]


def test_profile_keeps_every_admission(spark, inputs):
    profile = clinical.clinical_profile(inputs.admissions, inputs.diseases)
    total = profile.agg(F.sum("internacoes"), F.count(F.when(F.col("capitulo").isNull(), 1))).first()
    assert total[0] == inputs.admissions.count() and total[1] > 0


def test_clusters_cover_every_hospital(spark, inputs):
    scaled = cluster.scaled_features(inputs.features)
    bend = cluster.elbow(scaled, range(2, 6))
    assert [k for k, _ in bend.costs] == [2, 3, 4, 5]
    assert bend.best_k() in (3, 4)
    assigned = cluster.assign_clusters(scaled, 3)
    assert sorted(r.co_cnes for r in assigned.collect()) == sorted(
        r.co_cnes for r in inputs.features.collect()
    )


def test_elbow_takes_the_sharpest_bend():
    assert cluster.Elbow([(2, 100.0), (3, 50.0), (4, 45.0), (5, 41.0)]).best_k() == 3


def test_size_groups(spark):
    df = spark.createDataFrame([(0,), (50,), (51,), (500,), (501,), (None,)], "b int")
    assert [r[0] for r in df.select(cluster.size_group(F.col("b"))).collect()] == [
        "PEQUENO",
        "PEQUENO",
        "MEDIO",
        "GRANDE",
        "ESPECIAL",
        None,
    ]


def test_answers_skip_thoughts(spark):
    bodies = [
        '{"candidates":[{"content":{"parts":[{"text":"hm","thought":true},{"text":"SELECT 1"}]}}]}',
        '{"candidates":[{"content":{"parts":[{"text":"a","thought":false},{"text":"b"}]}}]}',
        '{"candidates":[{"content":{"parts":[{"text":"hm","thought":true}]}}]}',
        '{"candidates":[]}',
        '{"error":{"code":429}}',
        "not json",
        None,
    ]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, r string")
    got = [r[0] for r in df.orderBy("i").select(questions.answer_text(F.col("r"))).collect()]
    assert got == ["SELECT 1", "a", None, None, None, None, None]


def test_request_body_escapes(spark):
    text = 'a "b"\\ c\n\td é'
    df = spark.createDataFrame([(text,)], "t string").select(
        questions.request_body(F.col("t")).alias("b")
    )
    assert df.select(F.get_json_object("b", "$.contents[0].parts[0].text")).first()[0] == text
