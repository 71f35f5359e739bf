"""Raw CSV tables through the whole pipeline, and bucketed bronze tables."""

from __future__ import annotations

import shutil
from dataclasses import replace

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from goldpan.__main__ import main
from goldpan.operators import gold, silver
from goldpan.plans.medallion import from_store_csv, refresh, refresh_and_publish
from goldpan.plans.reports import report
from goldpan.sources import publication, store_csv
from goldpan.sources import star_tables as star
from goldpan.sources.snapshot import published_gold
from goldpan.sources.writers import write_bronze, write_bucketed, write_layer

RAW = {
    "orders": [
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
        "order_delivered_customer_date,order_estimated_delivery_date",
        "o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 11:00:00,2018-01-02 00:00:00,2018-01-12 20:00:00,2018-01-10 00:00:00",
        "o2,c2,delivered,2018-02-01 10:00:00,,,2018-02-05 20:00:00,2018-02-10 00:00:00",
        "o3,c3,canceled,2018-02-01 10:00:00,,,,2018-02-10 00:00:00",
        "o4,c3,delivered,2018-03-01 10:00:00,,,2018-03-10 00:00:00,2018-03-10 00:00:00",
    ],
    "customers": [
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state",
        "c1,u1,01001,sao paulo,SP",
        'c2,u2,20000,"rio, centro",RJ',
        "c3,u3,58000,joao pessoa,SP",
    ],
    "order_items": [
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value",
        "o1,1,p1,s1,2018-01-05 00:00:00,100.10,9.90",
        "o1,2,p2,s1,2018-01-05 00:00:00,50.05,9.90",
        "o2,1,p1,s1,2018-02-05 00:00:00,80.00,10.00",
        "o3,1,p1,s1,2018-02-05 00:00:00,80.00,10.00",
        "o4,1,p1,s2,2018-03-05 00:00:00,19.99,0.01",
    ],
    "order_payments": [
        "order_id,payment_sequential,payment_type,payment_installments,payment_value",
        "o1,1,credit_card,3,150.00",
        "o1,2,voucher,1,19.95",
        "o2,1,boleto,1,90.00",
        "o4,1,credit_card,8,20.00",
    ],
    "order_reviews": [
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
        "review_answer_timestamp",
        'r1,o1,2,,"atrasou\nmuito, ""mesmo""",2018-01-13 00:00:00,2018-01-14 00:00:00',
        "r2,o1,4,ok,,2018-01-13 00:00:00,2018-01-14 00:00:00",
        "r3,o4,5,,,2018-03-13 00:00:00,2018-03-14 00:00:00",
    ],
    "products": ["product_id,product_category_name," + ",".join(["x"] * 7), "p1,moveis,1,2,3,4,5,6,7"],
    "sellers": ["seller_id,seller_zip_code_prefix,seller_city,seller_state", "s1,01001,sao paulo,SP"],
}


@pytest.fixture(scope="module")
def raw_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, lines in RAW.items():
        (folder / f"shop_{name}_dataset.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def test_seven_tables_load(spark, raw_folder):
    tables = store_csv.bronze(spark, raw_folder)
    assert {n: t.count() for n, t in tables.items()} == {
        "orders": 4, "customers": 3, "order_items": 5, "order_payments": 4, "order_reviews": 3, "products": 1, "sellers": 1,
    }
    text = tables["order_reviews"].filter("review_id = 'r1'").first().review_comment_message
    assert text == 'atrasou\nmuito, "mesmo"'


def test_gold_from_csv(spark, raw_folder):
    model = from_store_csv(spark, store_csv.bronze(spark, raw_folder))
    rows = {r.customer_state: r for r in model.gold_state().collect()}
    from_silver = gold.gold_state(gold.state_totals(model.enriched())).collect()
    assert {r.customer_state: r for r in from_silver} == rows
    sp = rows["SP"]
    assert (sp.regiao, sp.pib_per_capita, sp.classe_economica, sp.total_pedidos) == ("Sudeste", 51559.3, "Rico", 2)
    assert (sp.ticket_medio, sp.media_itens, sp.media_parcelas) == (94.98, 1.5, 5.5)
    assert (sp.pct_parcelados, sp.pct_atrasados, sp.media_dias_atraso) == (100.0, 50.0, 1.0)
    assert (sp.satisfacao_media, sp.ticket_por_pib) == (3.67, 1.84)
    assert (rows["RJ"].satisfacao_media, rows["RJ"].pct_parcelados, rows["RJ"].media_dias_atraso) == (None, 0.0, -5.0)


def test_refresh_from_stored_bronze(spark, raw_folder, tmp_path):
    bronze = write_bronze(store_csv.bronze(spark, raw_folder), str(tmp_path / "bronze"))
    model = from_store_csv(spark, bronze)
    stored = refresh(model, str(tmp_path / "lake"))
    assert {tuple(r) for r in stored["gold_state"].collect()} == {tuple(r) for r in model.gold_state().collect()}
    assert {r.order_id: r.n_items for r in stored["silver_items"].collect()} == {"o1": 2, "o2": 1, "o3": 1, "o4": 1}
    assert all(r.passed for r in stored["dq_report"].collect())
    answers = report(stored["gold_state"])
    assert answers["dashboard_kpis"].first().orders == 3
    assert answers["q_top_ticket"].first().state == "SP"


def test_command_line(spark, raw_folder, tmp_path, capfd):
    lake = str(tmp_path / "lake")
    assert main(["refresh", "--layout", "csv", "--input", raw_folder, "--output", lake]) == 0
    assert main(["report", "--lake", lake]) == 0
    assert main(["select", "--lake", lake, "SELECT customer_state, total_pedidos FROM gold_state ORDER BY 2 DESC"]) == 0
    assert main(["select", "--lake", lake, "DROP VIEW gold_state"]) == 1
    out, err = capfd.readouterr()
    assert "q_top_ticket" in out and "|SP            |2            |" in out
    assert err.strip()
    star_lake = str(tmp_path / "star")
    assert main(["refresh", "--layout", "star", "--input", "/root/testdata/sf0.001", "--output", star_lake]) == 0
    assert publication.current(spark, star_lake).read(spark, "gold_kpis").first().orders == 484


def test_publication(spark, tmp_path):
    root = str(tmp_path / "lake")
    gold = spark.createDataFrame([("SP", 2), ("RJ", 1)], "customer_state string, total_pedidos long")
    aside = spark.createDataFrame([("AC", 9)], gold.schema)

    def add(rows):
        folder = publication.version_folder(root)
        return publication.publish_version(spark, root, folder, {"gold_state": write_layer(rows, f"{folder}/gold_state")})

    def seen():
        return {(r.customer_state, r.source, r.reason) for r in published_gold(spark, root, aside).collect()}

    assert publication.current(spark, root) is None and seen() == {("AC", "snapshot", "missing")}
    first = add(gold)
    assert seen() == {("SP", "table", None), ("RJ", "table", None)}
    second = add(gold.where("total_pedidos = 1"))
    assert (first.number, second.number) == (1, 2) and seen() == {("RJ", "table", None)}
    # a version whose files are gone, or that is empty, is passed over for the one before
    shutil.rmtree(tmp_path / "lake" / "versions" / second.version)
    assert seen() == {("SP", "snapshot", "missing"), ("RJ", "snapshot", "missing")}
    add(gold.limit(0))
    assert seen() == {("SP", "snapshot", "empty"), ("RJ", "snapshot", "empty")}
    fourth = add(gold)
    (tmp_path / "lake" / "versions" / fourth.version / "gold_state" / "part-x.parquet").write_text("no table")
    for file in (tmp_path / "lake" / "versions" / fourth.version / "gold_state").glob("part-0*"):
        file.unlink()
    assert {r for _, _, r in seen()} == {"unreadable"}
    last = add(gold)
    assert publication.prune(spark, root, keep=1) != [] and [p.number for p in publication.history(spark, root)] == [last.number]
    assert {p.name for p in (tmp_path / "lake" / "versions").iterdir()} == {last.version} and len(seen()) == 2


def test_failed_refresh_leaves_the_published_version(spark, raw_folder, tmp_path):
    root = str(tmp_path / "lake")
    model = from_store_csv(spark, store_csv.bronze(spark, raw_folder))
    _, version = refresh_and_publish(spark, model, root)
    broken = replace(model, states=model.states.withColumn("state", F.lit(None).cast("string")))
    tables, none = refresh_and_publish(spark, broken, root)
    assert none is None and not tables["dq_report"].filter("NOT passed").isEmpty()
    failing = replace(model, orders=model.orders.withColumn("customer_id", F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        refresh_and_publish(spark, failing, root)
    assert publication.current(spark, root).version == version.version
    assert {r.source for r in published_gold(spark, root, model.gold_state()).collect()} == {"table"}


def test_publishers_at_once_take_numbers_of_their_own(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    gold = spark.createDataFrame([("SP", 2)], "customer_state string, total_pedidos long")
    first = publication.publish_version(spark, root, publication.version_folder(root, "a"), {"gold_state": gold})
    known, asked = publication._numbers, []

    def late(spark, root):
        asked.append(1)
        return [] if len(asked) == 1 else known(spark, root)  # has not seen the other's manifest yet

    monkeypatch.setattr(publication, "_numbers", late)
    second = publication.publish_version(spark, root, publication.version_folder(root, "b"), {"gold_state": gold})
    assert (first.number, second.number) == (1, 2)
    assert [p.version for p in publication.history(spark, root)] == ["b", "a"]


def test_malformed_rows_stop_the_load(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,a,SP,extra\n")
    with pytest.raises((PySparkException, Py4JError), match="(?i)malformed"):
        store_csv.read_csv(spark, str(tmp_path), "sellers").collect()


def test_gdp_seed_has_all_states(spark):
    rows = store_csv.gdp_seed(spark).collect()
    assert len({r.state for r in rows}) == 27 and all(r.income_class for r in rows)
    assert sorted(r.state for r in rows if r.income_class == "Médio") == ["ES", "GO", "MG", "MS"]


def test_bucketed_bronze_needs_no_shuffle_on_order(spark, folder):
    tables = star.bronze(spark, folder)
    orders = write_bucketed(star.delivered_orders(tables["orders"]), "bronze_orders_bucketed", "order_id", 4)
    lines = write_bucketed(star.order_lines(tables["lineitem"]), "bronze_lines_bucketed", "order_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = silver.order_facts(orders, silver.line_facts(lines))
        plan = facts._jdf.queryExecution().executedPlan().toString()
        found = facts.agg(F.count(F.lit(1)), F.sum("paid_cents")).first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    plain = silver.order_facts(star.delivered_orders(tables["orders"]), silver.line_facts(star.order_lines(tables["lineitem"])))
    assert found == plain.agg(F.count(F.lit(1)), F.sum("paid_cents")).first()
