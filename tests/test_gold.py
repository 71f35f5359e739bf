"""Silver and gold on small hand-made orders, with brute-force results, and the golden dashboard figures."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from goldpan import catalog as cat
from goldpan.functions.bands import income_class, late_severity
from goldpan.functions.measures import cents, from_cents
from goldpan.operators import dashboard, gold, quality, questions, silver, skew
from goldpan.plans import medallion
from goldpan.plans.medallion import OrderModel
from goldpan.plans.reports import report
from goldpan.session import scale_conf
from goldpan.sources.snapshot import gold_or_snapshot, read_snapshot
from goldpan.sources.writers import publish

STATES = [
    (1, "AA", "Norte", 50000.0, "Rico"),
    (2, "BB", "Norte", 30000.0, "Médio"),
    (3, "CC", "Sul", 0.0, "Baixa Renda"),
    (4, "DD", "Sul", 9000.0, "Baixa Renda"),
]


def half_up(value, decimals):
    if value is None:
        return None
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-decimals), ROUND_HALF_UP))


def make_orders(seed=7, orders=900, customers=40, hot_share=0.4):
    """Orders of which one customer holds a large share; some have no lines, some customers no reviews."""
    rng = random.Random(seed)
    start = dt.date(2018, 1, 1)
    rows, lines = [], []
    for order in range(orders):
        customer = 0 if rng.random() < hot_share else rng.randrange(1, customers)
        ordered = start + dt.timedelta(days=rng.randrange(300))
        rows.append((order, customer, ordered, ordered + dt.timedelta(days=20)))
        for _ in range(rng.choice([0, 1, 1, 2, 5])):
            shipped = dt.datetime.combine(ordered, dt.time(9)) + dt.timedelta(days=rng.randrange(30))
            lines.append((order, rng.randrange(1, 10**6) / 100, rng.randrange(1, 5), shipped))
    people = [(c, c % 5 + 1) for c in range(customers)]  # state 5 does not exist
    scores = [(c, rng.randrange(1, 6)) for c in range(0, customers, 3) for _ in range(c % 4 + 1)]
    return rows, lines, people, scores


@pytest.fixture(scope="module")
def data():
    return make_orders()


@pytest.fixture(scope="module")
def model(spark, data):
    rows, lines, people, scores = data
    orders = spark.createDataFrame(rows, "order_id bigint, customer_id bigint, ordered date, promised date")
    line_frame = spark.createDataFrame(lines, "order_id bigint, value double, instalments int, shipped timestamp_ntz")
    states = spark.createDataFrame(STATES, "state_key int, state string, region string, gdp double, income_class string")
    return OrderModel(
        orders=orders,
        per_order={"line_facts": silver.line_facts(line_frame)},
        reviews=silver.review_scores(spark.createDataFrame(scores, "customer_id bigint, score bigint"), "customer_id"),
        customers=spark.createDataFrame(people, "customer_id bigint, state_key int"),
        states=states,
    )


@pytest.fixture(scope="module")
def expected(data):
    """Enriched orders by plain loops."""
    rows, lines, people, scores = data
    per_order, per_customer = defaultdict(list), defaultdict(list)
    for order, *line in lines:
        per_order[order].append(line)
    for customer, score in scores:
        per_customer[customer].append(score)
    states = {key: rest for key, *rest in STATES}
    home = dict(people)
    found = {}
    for order, customer, ordered, promised in rows:
        if order not in per_order or home[customer] not in states:
            continue
        mine = per_order[order]
        delivered = max(shipped for _, _, shipped in mine).date()
        instalments = min(i for _, i, _ in mine)
        reviewed = per_customer.get(customer)
        found[order] = {
            "customer_id": customer,
            "ordered": ordered,
            "delivered": delivered,
            "promised": promised,
            "delay_days": (delivered - promised).days,
            "is_late": delivered > promised,
            "n_items": len(mine),
            "paid": sum(Decimal(str(v)) for v, _, _ in mine),
            "instalments": instalments,
            "in_instalments": instalments > 1,
            "score_sum": sum(reviewed) if reviewed else None,
            "score_count": len(reviewed) if reviewed else None,
            "state": states[home[customer]][0],
        }
    return found


def test_enriched_orders(model, expected):
    found = {r.order_id: r.asDict() for r in model.enriched().collect()}
    assert found.keys() == expected.keys()
    for order, row in expected.items():
        assert {k: found[order][k] for k in row} == row
        assert found[order]["items_value"] == row["paid"]


def expected_gold(orders, gdp):
    n = len(orders)
    mean = lambda key: sum(o[key] for o in orders) / n
    reviewed = [o for o in orders if o["score_count"]]
    ticket = half_up(float(sum(o["paid"] for o in orders)) / n, 2)
    return {
        "total_pedidos": n,
        "ticket_medio": ticket,
        "media_itens": half_up(mean("n_items"), 2),
        "media_parcelas": half_up(mean("instalments"), 2),
        "pct_parcelados": half_up(100 * sum(o["in_instalments"] for o in orders) / n, 1),
        "satisfacao_media": half_up(
            sum(o["score_sum"] for o in reviewed) / sum(o["score_count"] for o in reviewed) if reviewed else None, 2
        ),
        "pct_atrasados": half_up(100 * sum(o["is_late"] for o in orders) / n, 1),
        "media_dias_atraso": half_up(mean("delay_days"), 1),
        "ticket_por_pib": half_up(1000 * ticket / gdp, 2) if gdp else None,
    }


def test_gold_state_both_ways(model, expected):
    direct = {r.customer_state: r.asDict() for r in model.gold_state().collect()}
    from_silver = gold.gold_state(gold.state_totals(model.enriched()))
    assert {r.customer_state: r.asDict() for r in from_silver.collect()} == direct
    for _, state, region, gdp, name in STATES:
        orders = [o for o in expected.values() if o["state"] == state]
        want = expected_gold(orders, gdp) | {"regiao": region, "pib_per_capita": gdp, "classe_economica": name}
        assert {k: direct[state][k] for k in want} == want
    assert sum(r["total_pedidos"] for r in direct.values()) == len(expected)
    assert all(0 <= r[c] <= 100 for r in direct.values() for c in ("pct_atrasados", "pct_parcelados"))


def test_class_and_kpis_are_order_weighted(model, expected):
    totals = model.state_totals()
    kpis = gold.gold_kpis(totals).first()
    want = expected_gold(list(expected.values()), 0)
    assert kpis.orders == want["total_pedidos"]
    assert half_up(kpis.avg_ticket, 2) == want["ticket_medio"]
    assert half_up(kpis.pct_late, 1) == want["pct_atrasados"]
    by_class = {r.income_class: r for r in gold.gold_class(totals).collect()}
    poor = [o for o in expected.values() if o["state"] in ("CC", "DD")]
    assert by_class["Baixa Renda"].orders == len(poor)
    assert by_class["Baixa Renda"].avg_instalments == half_up(sum(o["instalments"] for o in poor) / len(poor), 4)


def test_kpis_of_no_orders(model):
    assert tuple(gold.gold_kpis(model.state_totals().filter("false")).first()) == (0, None, None, None)


def test_refresh_writes_all_layers(model, expected, tmp_path):
    stored = medallion.refresh(model, str(tmp_path))
    assert stored["silver_orders_enriched"].count() == len(expected)
    assert {tuple(r) for r in stored["gold_state"].collect()} == {tuple(r) for r in model.gold_state().collect()}
    assert {r.order_id for r in stored["silver_delivered"].collect()} == {r.order_id for r in model.orders.collect()}
    assert expected.keys() <= {r.order_id for r in stored["silver_delivered"].collect()}
    items = {r.order_id: r for r in stored["silver_items"].collect()}
    paid = {r.order_id: r for r in stored["silver_payments"].collect()}
    for order, row in expected.items():
        assert (items[order].n_items, items[order].items_value) == (row["n_items"], row["paid"])
        assert (paid[order].paid, paid[order].in_instalments) == (row["paid"], row["in_instalments"])
    assert {tuple(r) for r in stored["silver_reviews"].collect()} == {tuple(r) for r in model.reviews.collect()}
    report = stored["dq_report"].collect()
    assert len(report) == len(medallion.LAYER_CHECKS) + 1 and all(r.passed for r in report)
    again = medallion.refresh(model, str(tmp_path / "orc"), "orc")
    assert again["gold_kpis"].first() == gold.gold_kpis(model.state_totals()).first()


def test_cents_are_exact(spark):
    rng = random.Random(3)
    amounts = [rng.randrange(-(10**14), 10**14) for _ in range(5000)] + list(range(-300, 300))
    frame = spark.createDataFrame([(k, k / 100) for k in amounts], "k bigint, value double")
    assert frame.filter(cents(F.col("value")) != F.col("k")).isEmpty()
    assert frame.filter(from_cents(F.col("k")).cast("double") != F.col("value")).isEmpty()
    assert spark.createDataFrame([(float("nan"),)], "v double").select(cents(F.col("v"))).first()[0] is None


def test_orders_without_delivery_date_have_no_delay(spark, model):
    lost = model.facts.withColumn("delivered", F.when(F.col("order_id") % 2 == 0, F.col("delivered")))
    timed = model.facts.filter("order_id % 2 = 0")
    with_lost, only_timed = (
        {r.customer_state: r for r in gold.gold_state(gold.state_totals_from_facts(f, model.profiles)).collect()}
        for f in (silver.with_delay(lost.drop("delay_days", "is_late")), timed)
    )
    for state, row in with_lost.items():
        assert row.pct_atrasados == only_timed[state].pct_atrasados
        assert row.media_dias_atraso == only_timed[state].media_dias_atraso
        assert row.total_pedidos > only_timed[state].total_pedidos


# Skew


def test_sketches_merge_as_a_tree(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keys = spark.range(0, 400_000, 1, 200).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
        hot = skew.hot_keys(keys, "k", 50_000)
        plan = hot._jdf.queryExecution().executedPlan().toString()
        assert [(r.k, r._parts) for r in hot.collect()] == [(7, 3)]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # one exchange deals the sketches of splits to groups, and only merged groups go on to the last task
    last, merged = plan.split("approx_top_k_accumulate", 1)
    assert last.count("Exchange") == 1 and "partial_approx_top_k_combine" in last
    assert merged.count("Exchange") == 1 and "Exchange hashpartitioning(group" in merged
    assert skew.hot_keys(keys.limit(0), "k", 1).collect() == []
    groups = keys.select((F.spark_partition_id() % skew.SKETCH_GROUPS).alias("g")).distinct().count()
    assert groups == skew.SKETCH_GROUPS < 200


def test_hot_keys_are_found_and_bounded(spark):
    keys = spark.range(90_000).select(F.when(F.col("id") < 30_000, 7).otherwise(F.col("id")).alias("k"))
    [(key, parts)] = skew.hot_keys(keys, "k", 5_000).collect()
    assert key == 7 and 6 <= parts <= 8  # the sketch counts with a small error
    assert skew.hot_keys(keys, "k", 100_000).count() == 0


def test_hot_join_is_exact_and_spread(spark):
    facts = spark.range(60_000).select(
        F.col("id").alias("order_id"), F.when(F.col("id") < 20_000, 7).otherwise(F.col("id") % 999).alias("customer_id")
    )
    names = spark.range(900).select(F.col("id").alias("customer_id"), (F.col("id") * 10).alias("v"))
    joined = skew.join_spreading_hot_keys(
        facts, names, "customer_id", "order_id", facts.select("customer_id"), rows_per_part=500
    )
    assert joined.columns == ["customer_id", "order_id", "v"]
    plain = facts.join(names, "customer_id").select(joined.columns)
    assert joined.count() == plain.count() and joined.exceptAll(plain).isEmpty()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = skew.join_spreading_hot_keys(
            facts, names, "customer_id", "order_id", facts.select("customer_id"), rows_per_part=500
        )
        sizes = [r["count"] for r in again.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8


def test_hot_join_with_string_and_null_keys(spark):
    facts = spark.createDataFrame([("a", i) for i in range(50)] + [(None, 98), ("b", 99)], "k string, id int")
    names = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    rows = skew.join_spreading_hot_keys(facts, names, "k", "id", facts.select("k"), rows_per_part=10).collect()
    assert sorted((r.id, r.v) for r in rows) == [(i, 1) for i in range(50)] + [(99, 2)]


# Golden figures. Public gold rows (orders, ticket, satisfaction, late rate) per state.
GOLDEN = [
    ("SP", 40501, 163.40, 4.25, 5.9),
    ("RJ", 12767, 168.30, 4.08, 9.8),
    ("MG", 11354, 162.10, 4.19, 5.6),
    ("RS", 5345, 171.20, 4.19, 7.1),
    ("PR", 4923, 167.80, 4.24, 5.0),
    ("SC", 3546, 174.50, 4.21, 6.2),
    ("BA", 3380, 208.40, 3.99, 13.1),
    ("DF", 2144, 178.90, 4.18, 7.8),
    ("GO", 2020, 165.70, 4.14, 8.2),
    ("PE", 1652, 212.10, 3.95, 14.8),
    ("CE", 1336, 215.30, 3.93, 16.4),
    ("ES", 1333, 163.90, 4.15, 6.8),
    ("MA", 747, 221.50, 3.90, 18.2),
    ("MT", 886, 172.30, 4.15, 6.8),
    ("MS", 715, 166.80, 4.12, 8.5),
    ("PB", 536, 266.61, 3.88, 11.0),
    ("PI", 412, 219.80, 3.91, 17.1),
    ("RN", 481, 213.60, 3.94, 15.2),
    ("SE", 348, 210.90, 3.96, 14.1),
    ("AL", 413, 237.21, 3.85, 23.9),
    ("PA", 472, 218.70, 4.05, 8.9),
    ("AM", 340, 225.40, 4.08, 7.2),
    ("AC", 81, 244.69, 4.10, 3.8),
    ("AP", 67, 240.92, 4.12, 4.5),
    ("RO", 253, 234.43, 4.10, 2.9),
    ("RR", 46, 231.80, 4.11, 5.2),
    ("TO", 537, 222.10, 4.09, 6.8),
]


@pytest.fixture(scope="module")
def golden(spark):
    """Gold rows from the GDP seed and the published figures; the columns not published here are constant."""
    seed = cat.lookup(spark, cat.STATE_GDP, "customer_state string, regiao string, pib_per_capita double")
    figures = cat.lookup(
        spark,
        GOLDEN,
        "customer_state string, total_pedidos bigint, ticket_medio double, satisfacao_media double, pct_atrasados double",
    )
    full = seed.join(figures, "customer_state").withColumns(
        {
            "classe_economica": income_class(F.col("pib_per_capita")),
            "media_itens": F.lit(1.0),
            "media_parcelas": F.lit(3.0),
            "pct_parcelados": F.lit(50.0),
            "media_dias_atraso": F.lit(-1.0),
            "ticket_por_pib": F.round(F.col("ticket_medio") * 1000 / F.col("pib_per_capita"), 2),
        }
    )
    return full.select(*cat.GOLD_COLUMNS)


def test_golden_kpis(golden):
    row = dashboard.dashboard_kpis(golden).first()
    assert row.orders == 96635
    assert tuple(round(v, 4) for v in row[1:]) == (202.9022, 9.6593, 4.0689)


def test_golden_classes(golden):
    counts = {r.classe_economica: r["count"] for r in golden.groupBy("classe_economica").count().collect()}
    assert counts == {"Baixa Renda": 16, "Rico": 7, "Médio": 4}
    tickets = {r.income_class: (round(r.avg_ticket, 4), r.states) for r in questions.ticket_by_class(golden).collect()}
    assert tickets == {"Baixa Renda": (226.4663, 16), "Médio": (164.625, 4), "Rico": (170.9143, 7)}


def test_golden_rankings(golden):
    assert [tuple(r) for r in dashboard.top_states(golden).collect()] == [
        ("SP", 40501), ("RJ", 12767), ("MG", 11354), ("RS", 5345), ("PR", 4923), ("SC", 3546), ("BA", 3380),
    ]
    assert [r.state for r in questions.top_delivery_states(golden).collect()] == ["RO", "AC", "AP"]
    assert tuple(questions.state_with_highest_ticket(golden).first()) == ("PB", 266.61)


def test_golden_regions(golden):
    found = [(r.region, round(r.pct_late, 4), r.severity) for r in dashboard.region_late(golden).collect()]
    assert found == [
        ("Nordeste", 15.9778, "danger"),
        ("Centro-Oeste", 7.825, "success"),
        ("Sudeste", 7.025, "success"),
        ("Sul", 6.1, "success"),
        ("Norte", 5.6143, "success"),
    ]
    worst = questions.region_with_highest_late_rate(golden).first()
    assert (worst.region, round(worst.pct_late_weighted, 2)) == ("Nordeste", 14.97)


def test_golden_correlation_and_ratio(golden):
    assert tuple(questions.gdp_and_satisfaction(golden).first()) == (0.711145, 27)
    ratios = {r.customer_state: r.ticket_por_pib for r in golden.collect()}
    assert (ratios["SP"], ratios["PB"], ratios["PI"]) == (3.17, 17.69, 16.57)


# Boundaries


@pytest.mark.parametrize(
    "rate, severity", [(8.0, "success"), (8.01, "warn"), (12.0, "warn"), (12.01, "danger"), (None, None)]
)
def test_severity_limits(spark, rate, severity):
    frame = spark.createDataFrame([(rate,)], "rate double")
    assert frame.select(late_severity(F.col("rate"))).first()[0] == severity


@pytest.mark.parametrize(
    "gdp, name",
    [(40000.0, "Rico"), (39999.9, "Médio"), (25000.0, "Médio"), (24999.9, "Baixa Renda"), (None, None)],
)
def test_income_class_limits(spark, gdp, name):
    frame = spark.createDataFrame([(gdp,)], "gdp double")
    assert frame.select(income_class(F.col("gdp"))).first()[0] == name


def test_missing_class_keeps_its_row(golden):
    rows = dashboard.class_profile(golden.filter("classe_economica <> 'Médio'")).orderBy("position").collect()
    assert [(r.income_class, r.avg_instalments, r.pct_scaled) for r in rows] == [
        ("Baixa Renda", 3.0, 5.0),
        ("Médio", None, None),
        ("Rico", 3.0, 5.0),
    ]


def test_nan_and_null_groups_are_skipped(spark, golden):
    odd = golden.withColumn("pct_atrasados", F.when(F.col("customer_state") == "SP", float("nan")).otherwise(8.0))
    odd = odd.withColumn("regiao", F.when(F.col("regiao") != "Sul", F.col("regiao")))
    rows = dashboard.region_late(odd).collect()
    assert {(r.pct_late, r.severity) for r in rows} == {(8.0, "success")}
    assert {r.region for r in rows} == {"Nordeste", "Centro-Oeste", "Sudeste", "Norte"}


def test_display_pairs_names_and_survives_missing_columns(golden):
    shown = dashboard.display(golden.drop("regiao", "pct_parcelados"))
    assert shown.columns == [h for n, h in cat.DISPLAY_COLUMNS if n not in ("regiao", "pct_parcelados")] + ["class_band"]
    row = shown.filter("Estado = 'PB'").first()
    assert (row["Ticket Médio"], row["Pedidos"], row["class_band"]) == (266.6, 536, "Baixa Renda")
    bands = dashboard.scatter(golden.withColumn("classe_economica", F.lit("?"))).select("class_band").distinct()
    assert [r[0] for r in bands.collect()] == ["Baixa Renda"]


def test_reports_on_an_empty_gold_table(golden):
    rows = {name: frame.collect() for name, frame in report(golden.filter("false")).items()}
    assert tuple(rows.pop("dashboard_kpis")[0]) == (0, None, None, None)
    assert tuple(rows.pop("q_gdp_satisfaction")[0]) == (None, 0)
    assert [r.avg_instalments for r in rows.pop("class_profile")] == [None] * 3
    assert not any(rows.values())


def test_correlation_of_equal_values_is_null(golden):
    same = golden.withColumn("satisfacao_media", F.lit(3.07))
    assert tuple(questions.gdp_and_satisfaction(same).first()) == (None, 27)
    assert tuple(questions.gdp_and_satisfaction(golden.withColumn("pib_per_capita", F.lit(0.1))).first())[0] is None
    assert tuple(questions.gdp_and_satisfaction(golden.limit(1)).first()) == (None, 1)
    line = golden.withColumn("satisfacao_media", F.col("pib_per_capita") * -2)
    assert tuple(questions.gdp_and_satisfaction(line).first()) == (-1.0, 27)


def test_instalment_gap_to_rich(golden):
    varied = golden.withColumn("pct_parcelados", F.when(F.col("classe_economica") == "Rico", 50.0).otherwise(60.5))
    gaps = {r.income_class: r.diff_from_rich for r in questions.instalments_by_class(varied).collect()}
    assert gaps == {"Baixa Renda": 10.5, "Médio": 10.5, "Rico": 0.0}


def test_lost_orders_are_counted_by_first_cause(spark):
    orders = spark.createDataFrame([(i, c) for i, c in enumerate([1, 1, 1, 2, 3, 9, None, 1])], "order_id long, customer_id long")
    items = spark.createDataFrame([(i,) for i in (0, 1, 2, 3, 4, 5, 6)], "order_id long")
    payments = spark.createDataFrame([(i,) for i in (0, 1, 3, 4, 5, 6)], "order_id long")
    customers = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "customer_id long, state_key long")
    states = spark.createDataFrame([(10,)], "state_key long")
    lost = quality.lost_orders(orders, {"items": items, "payments": payments}, customers, states)
    assert {r.cause: r.lost for r in lost.collect()} == {"items": 1, "payments": 1, "customer": 2, "state": 2}
    kept = orders.where("order_id IN (0, 1)")
    assert quality.reconciled(orders, kept, lost).first().passed
    assert quality.reconciled(orders, kept.limit(1), lost).first().failures == 1
    none = quality.lost_orders(orders.limit(0), {"items": items, "payments": payments}, customers, states)
    assert [r.lost for r in none.collect()] == [0, 0, 0, 0]


def test_provenance_of_gold(spark, golden, tmp_path):
    snapshot = golden.limit(3)
    missing = gold_or_snapshot(spark, "no_such_table", snapshot).collect()
    assert {(r.source, r.reason) for r in missing} == {("snapshot", "missing")}
    golden.createOrReplaceTempView("gold_view_live")
    live = gold_or_snapshot(spark, "gold_view_live", snapshot)
    assert live.count() == 27 and live.first().source == "table" and live.first().reason is None
    golden.filter("false").createOrReplaceTempView("gold_view_empty")
    empty = gold_or_snapshot(spark, "gold_view_empty", snapshot).first()
    assert (empty.source, empty.reason) == ("snapshot", "empty")
    publish(golden, "gold_published")
    published = gold_or_snapshot(spark, "gold_published", snapshot)
    assert published.count() == 27 and published.first().source == "table"
    spark.sql("DROP TABLE gold_published")
    assert gold_or_snapshot(spark, "gold_published", snapshot).first().source == "snapshot"
    path = str(tmp_path / "snapshot")
    golden.write.parquet(path)
    assert read_snapshot(spark, path).count() == 27
    assert dashboard.gold_scan(spark, "gold_view_live").first().customer_state == "SP"


def test_scale_settings_can_be_applied_to_a_session(spark):
    conf = scale_conf(25 * 1024**4)
    assert conf["spark.sql.shuffle.partitions"] == "204800"
    assert scale_conf(1)["spark.sql.shuffle.partitions"] == "8"
    assert all(spark.conf.isModifiable(key) for key in conf)
