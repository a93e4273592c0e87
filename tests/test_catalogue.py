import pytest

from weftline.plans import deliver, snapshots, state  # noqa: F401
from weftline.plans.catalogue import ORACLE, QUERIES

from .oracle import duck, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, con, name):
    same(spark, con, QUERIES[name], ORACLE[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0 and df.columns


def test_flagship_does_not_depend_on_partitions(spark):
    from weftline.operators import resolve
    from weftline.sources.adapters import logical

    listings = logical(spark, SF, "listings")
    a = resolve.dedupe(listings.repartition(1), 2026).collect()
    b = resolve.dedupe(listings.repartition(7, "source"), 2026).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_every_listing_is_grouped_or_quarantined(spark):
    from pyspark.sql import functions as F

    from weftline.operators import resolve
    from weftline.sources.adapters import logical

    listings = logical(spark, SF, "listings")
    grouped = resolve.dedupe(listings, 2026).agg(F.sum("n_listings")).first()[0]
    lost = resolve.with_keys(listings, 2026).where("domain IS NULL").count()
    assert grouped + lost == listings.count()


def test_people_cover_all_orders(spark):
    from pyspark.sql import functions as F

    from weftline.sources.adapters import logical

    firms = logical(spark, SF, "orders").join(logical(spark, SF, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.concat(F.lit("firm-"), F.col("o_custkey").cast("string"), F.lit(".co.in")).alias("domain"))
    assert firms.join(logical(spark, SF, "people"), "domain", "left_anti").count() == 0


def test_every_metric_occurs(spark):
    got = {r.metric: r.n for r in QUERIES["metric_counts"](spark, "/root/testdata/sf0.01").collect()}
    assert set(got) == set("att conn gm vc ss rr ev cn neg dcs won_d".split()) and all(got.values())
