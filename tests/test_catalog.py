from basketry.plans.pipeline import Models, materialize
from basketry.plans.reports import rpt_kpi, upper_columns
from basketry.sources.catalog import publish, register_views

SF = "/root/testdata/sf0.001"


def test_materialize_publish_and_query_with_sql(spark, scratch):
    m = Models.from_fixtures(spark, SF)
    written = materialize(m, scratch)
    assert "raw_orders" in written and "fact_order_products" in written
    publish(spark, scratch, ["fact_orders", "customer_360"], "marts")
    kpi = upper_columns(rpt_kpi(spark.table("marts.fact_orders"))).first()
    ours = m.report("rpt_kpi").first()
    assert (kpi.TOTAL_ORDERS, kpi.TOTAL_USERS) == (ours.total_orders, ours.total_users)
    assert kpi.AVG_BASKET_SIZE == ours.avg_basket_size
    assert spark.table("marts.fact_orders").count() == kpi.TOTAL_ORDERS == 1500
    register_views({"stg_orders_v": m.stg_orders})
    assert spark.sql("SELECT count(*) FROM stg_orders_v").first()[0] == 1500
