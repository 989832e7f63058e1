import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from bindings import checking
from cartulary.functions.pseudonyms import Pseudonyms
from cartulary.operators.policy import apply_policy, catalog
from cartulary.plans import marts
from cartulary.plans.allocation import MissingCost, allocate
from cartulary.plans.audit import freshness, volume_changes
from cartulary.plans.forecast import FEATURES, TooLittleData, TreeSettings, feature_table, forecast
from cartulary.plans.households import COMPONENTS, INADEQUACIES, classify
from cartulary.plans.ingest import retention_cutoff
from cartulary.plans.profiles import build_profiles, profiles_with_suppression, publish
from cartulary.sources.layouts import CONTRACTS, DEFICIT, FAMILY, FEEDS, MUNICIPALITIES, PERSON

KEY = "test key with at least 32 characters!!"
DAY = datetime.date(2026, 9, 11)

# -- layouts ------------------------------------------------------------------------------


def test_layout_sizes_and_names():
    sizes = {layout.name: len(layout.fields) for layout in (FAMILY, PERSON, CONTRACTS, MUNICIPALITIES, DEFICIT)}
    assert list(sizes.values()) == [66, 24, 9, 7, 7]
    assert set(FEEDS) == set(sizes)
    for feed in FEEDS.values():
        kept = [f.target for f in feed.layout.fields if f.action != "drop"]
        assert len(kept) == len(set(kept)) and len(set(feed.layout.names)) == len(feed.layout.names)
        assert all(f.kind in ("str", "int", "dec", "date") for f in feed.layout.fields)


def test_no_identifier_stays_in_clear():
    for feed in FEEDS.values():
        for f in feed.layout.fields:
            if f.category == "identifier":
                assert f.action in ("drop", "pseudonymize"), f.source
    domains = {f.detail for layout in (PERSON, CONTRACTS) for f in layout.fields if f.target == "cpf_pseudo"}
    assert domains == {"cpf"}


def test_policy_projection(spark):
    rows = [("FAR", cpf, "Ana", "100,00", "5300108", "70000-123", "01/01/2026", "1") for cpf in
            ("529.982.247-25", "52998224725", "529.982.247-24", None)]
    names = ["PROGRAMA", "NU_CPF_BENEFICIARIO", "NO_BENEFICIARIO", "VR_RENDA_FAMILIAR", "CO_MUNICIPIO_IBGE",
             "CO_CEP_IMOVEL", "DT_CONTRATACAO", "CO_FAIXA_RENDA"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    df = df.withColumn("DT_NASCIMENTO", F.lit(datetime.date(1990, 1, 1))).withColumn("_tech", F.lit(1))
    shown = apply_policy(df, CONTRACTS, Pseudonyms(spark, KEY), F.lit(DAY))
    got = shown.collect()
    assert [r.cpf_status for r in got] == ["valid", "valid", "invalid", "missing"]
    assert got[0].cpf_pseudo == got[1].cpf_pseudo and got[2].cpf_pseudo is None and got[3].cpf_pseudo is None
    assert {r.zip_prefix for r in got} == {"70000"} and {r.age for r in got} == {36}
    assert "NO_BENEFICIARIO" not in shown.columns and shown.columns[-1] == "_tech"
    listed = {r.column_name: (r.category, r.action) for r in catalog(spark, "c", shown).collect()}
    assert listed["cpf_pseudo"] == ("identifier", "pseudonymize") and listed["cpf_status"] == ("personal", "keep")
    assert set(listed) == set(shown.columns) - {"_tech"}
    with pytest.raises(ValueError):
        apply_policy(df, CONTRACTS, None, F.lit(DAY))


# -- households and marts -----------------------------------------------------------------

HOME = (
    "family_id string, wall_material int, dwelling_kind int, families_in_dwelling int, expense_rent decimal(14,2), "
    "total_income decimal(14,2), people_in_dwelling int, bedrooms int, piped_water int, has_bathroom int, "
    "sewage_disposal int, garbage_disposal int, lighting int, floor_material int"
)


def home(name, wall=1, kind=1, families=1, rent=None, income=2000, people=3, bedrooms=2, codes=(1, 1, 1, 1, 1, 2)):
    from decimal import Decimal

    money = lambda v: None if v is None else Decimal(v)
    return (name, wall, kind, families, money(rent), money(income), people, bedrooms, *codes)


def test_household_order(spark):
    rows = [
        (home("improvised", kind=2, families=3), "precarious_housing"),
        (home("walls", wall=6), "precarious_housing"),
        (home("shared", families=2, rent=1500), "cohabitation"),
        (home("burden", rent=601), "rent_burden"),
        (home("at the limit", rent=600), None),
        (home("no income", rent=10, income=None), "rent_burden"),
        (home("crowded", rent=100, people=7, bedrooms=2), "rented_overcrowding"),
        (home("crowded, owned", people=7, bedrooms=2), None),
        (home("no bedroom", rent=100, people=4, bedrooms=0), "rented_overcrowding"),
        (home("unknown walls", wall=None, codes=(None,) * 6), None),
    ]
    got = classify(spark.createDataFrame([r for r, _ in rows], HOME)).collect()
    assert [(r.family_id, r.deficit_component) for r in got] == [(r[0], c) for r, c in rows]
    assert all(r[i] is False for r in got for i in INADEQUACIES)
    bad = classify(spark.createDataFrame([home("bad", codes=(2, 2, 6, 3, 4, 1))], HOME)).first()
    assert all(bad[i] for i in INADEQUACIES)


def test_gap_keeps_every_area(spark):
    areas = spark.createDataFrame([(1, "A", "S", "R", 10), (2, "B", "S", "R", 20)],
                                  "municipality_code int, municipality_name string, state string, region string, households int")
    precarious = spark.createDataFrame([(1, 9, 4)], "municipality_code int, n_families long, n_families_deficit long")
    contracts = spark.createDataFrame([(1,)], "municipality_code int")
    deficit = spark.createDataFrame([(1, 2020, 5), (1, 2022, 3), (2, 2020, 8)],
                                    "municipality_code int, year int, deficit_total int")
    got = {r.municipality_code: r for r in marts.service_gap(precarious, contracts, deficit, areas).collect()}
    assert (got[1].gap_cadunico, got[1].gap_fjp, got[1].coverage_fjp, got[1].fjp_year) == (3, 2, 0.3333, 2022)
    assert (got[2].gap_cadunico, got[2].gap_fjp, got[2].coverage_cadunico, got[2].fjp_deficit) == (0, 0, None, None)


# -- allocation ---------------------------------------------------------------------------

AREA = "municipality_code int, region string, deficit_forecast_units double, precariousness_index double"


def test_allocation_by_hand(spark):
    areas = spark.createDataFrame([(1, "N", 40.0, 50.0), (2, "N", 40.0, 90.0), (3, "S", 40.0, 80.0), (4, "S", 0.0, 10.0)], AREA)
    got = {r.municipality_code: r for r in allocate(areas, 5000, {"N": 100, "S": 200}, 0.5, 0.8).collect()}
    assert sum(r.investment for r in got.values()) <= 5000
    assert all(0 <= r.allocated_units <= r.capacity for r in got.values())
    assert got[2].allocated_units == 20 and got[4].allocated_units == 0
    assert got[3].investment >= 0.8 * 5000 / 3 - 200
    with pytest.raises(MissingCost, match="S"):
        allocate(areas, 5000, {"N": 100})


def best_value(rows, budget, costs, cap, share):
    """The exact optimum of a tiny problem, by trying every combination."""
    caps = [int((r[2] or 0) * cap) for r in rows]
    need = sum(max(r[2] or 0, 0) for r in rows)
    floors = {}
    for region in {r[1] for r in rows}:
        mine = [i for i, r in enumerate(rows) if r[1] == region]
        part = sum(max(rows[i][2] or 0, 0) for i in mine) / need if need else 0
        floors[region] = max(0, min(share * budget * part, sum(caps[i] * costs[region] for i in mine)) - costs[region])
    best = None
    for units in itertools.product(*[range(c + 1) for c in caps]):
        spent = {}
        for u, r in zip(units, rows):
            spent[r[1]] = spent.get(r[1], 0) + u * costs[r[1]]
        if sum(spent.values()) <= budget and all(spent[g] >= floors[g] - 1e-9 for g in spent):
            value = sum(u * r[3] for u, r in zip(units, rows))
            best = value if best is None else max(best, value)
    return best, floors


def test_allocation_against_every_combination(spark):
    rng = random.Random(4)
    for _ in range(4):
        costs = {"N": rng.choice([100, 130]), "S": rng.choice([170, 90])}
        rows = [(i, rng.choice("NS"), float(rng.randrange(0, 12)), float(rng.randrange(0, 60))) for i in range(5)]
        budget = float(rng.randrange(300, 1500))
        best, floors = best_value(rows, budget, costs, 0.5, 0.8)
        got = allocate(spark.createDataFrame(rows, AREA), budget, costs, 0.5, 0.8).collect()
        assert sum(r.investment for r in got) <= budget
        for region, floor in floors.items():
            assert sum(r.investment for r in got if r.region == region) >= floor - 1e-9
        value = sum(r.allocated_units * r.precariousness_index for r in got)
        assert best is not None and value >= best - max(r[3] for r in rows)


def test_missing_priority_takes_the_median(spark):
    areas = spark.createDataFrame(
        [(1, "N", 10.0, 10.0), (2, "N", 10.0, None), (3, "N", 10.0, 30.0), (4, "N", None, 99.0), (5, "N", 10.0, float("nan"))], AREA
    )
    got = {r.municipality_code: r.allocated_units for r in allocate(areas, 2500, {"N": 100}, 1.0, 0.0).collect()}
    # median of 10, 30, 99 is 30: areas 2 and 5 tie with 3 and win over 1
    assert got == {1: 0, 2: 10, 3: 10, 4: 0, 5: 5}


# -- forecast -----------------------------------------------------------------------------


def forecast_frames(spark, sizes=(60, 45, 40, 30, 20, 10, 5)):
    """States of unequal size; the target falls and rises again with the rate, which no line follows."""
    rng = random.Random(1)
    areas, precarious, deficit = [], [], []
    for i in range(sum(sizes)):
        state = next(k for k in range(len(sizes)) if i < sum(sizes[: k + 1]))
        rate, households = rng.uniform(0, 0.6), 2000 + i
        areas.append((i, f"M{i}", f"S{state}", "N", households, 3 * households))
        noise = [rng.uniform(0, 0.3) for _ in (*COMPONENTS, *INADEQUACIES)]
        precarious.append((i, 700, rate, *noise, None if i == 4 else 800.0 - i, "x"))
        if i != 17:
            deficit += [(i, 2021, int(households * (0.02 + 0.8 * abs(rate - 0.3)))), (i, 2018, 1)]
    kinds = ", ".join(f"{k}_rate double" for k in (*COMPONENTS, *INADEQUACIES))
    return (
        spark.createDataFrame(
            precarious,
            f"municipality_code int, n_families int, deficit_rate double, {kinds}, median_per_capita_income double, state string",
        ),
        spark.createDataFrame(
            areas,
            "municipality_code int, municipality_name string, state string, region string, households int, population int",
        ),
        spark.createDataFrame(deficit, "municipality_code int, year int, deficit_total int"),
    )


def test_forecast(spark):
    data = feature_table(*forecast_frames(spark)).cache()
    assert data.count() == 210 and set(FEATURES) <= set(data.columns)
    assert data.where("relative_deficit IS NULL").count() == 1
    result = forecast(data, TreeSettings(iterations=8, step=0.4))
    assert result.metrics["r2_model"] > 0.6 > 0.3 > result.metrics["r2_baseline"]
    assert result.metrics["n_folds"] == 5 and result.metrics["n_municipalities"] == 209
    rows = result.predictions.collect()
    assert len(rows) == 210 and all(r.relative_deficit_forecast >= 0 for r in rows)
    unknown = next(r for r in rows if r.municipality_code == 17)
    assert unknown.relative_deficit_cv is None and unknown.deficit_forecast_units is not None
    with pytest.raises(TooLittleData):
        forecast(data.where("state = 'S1'"))


# -- audit --------------------------------------------------------------------------------


def test_volume_and_freshness(spark):
    day = datetime.datetime(2026, 1, 1)
    rows = [
        ("bronze", "t", status, day + datetime.timedelta(days=i), (day + datetime.timedelta(days=i)).date(), n)
        for i, (status, n) in enumerate(
            [("success", 100), ("success", 120), ("failed", 1), ("success", 110), ("success", 132), ("success", 133)]
        )
    ]
    runs = spark.createDataFrame(
        rows, "stage string, table_name string, status string, started_at timestamp, reference_date date, rows_in long"
    )
    got = [(r.rows_in, r.baseline, r.volume_change, r.unusual) for r in volume_changes(runs, 0.2).orderBy("started_at").collect()]
    # the limit is strict: 132 against 110 is exactly 20%
    assert got == [(100, None, None, False), (120, 100.0, 0.2, False), (110, 110.0, 0.0, False),
                   (132, 110.0, 0.2, False), (133, 120.0, 0.1083, False)]
    monitored = spark.createDataFrame([("t",), ("never",)], "table_name string")
    at = lambda days: {
        r.table_name: r.stale
        for r in freshness(runs, monitored, F.lit(datetime.date(2026, 1, 6) + datetime.timedelta(days=days)), 45, "bronze").collect()
    }
    assert at(45) == {"t": False, "never": True} and at(46) == {"t": True, "never": True}


def test_retention_cutoff():
    assert retention_cutoff(datetime.date(2026, 2, 28), 3) == datetime.date(2025, 11, 1)
    assert retention_cutoff(datetime.date(2026, 12, 1), 12) == datetime.date(2025, 12, 1)


# -- profiles -----------------------------------------------------------------------------


def test_profiles(spark, tmp_path):
    precarious = spark.sql(
        "SELECT 1 AS municipality_code, 'A' AS municipality_name, 'S' AS state, 'N' AS region, DATE '2026-09-11' AS reference_date, "
        "200L AS n_families, 50L AS n_families_deficit, CAST(0.25 AS DECIMAL(5,4)) AS deficit_rate, 40.5D AS precariousness_index, "
        "CAST(600 AS DECIMAL(14,2)) AS median_per_capita_income "
        "UNION ALL SELECT 2, 'B', 'S', 'N', DATE '2026-09-11', 40L, 3L, CAST(0.075 AS DECIMAL(5,4)), double('NaN'), CAST(500 AS DECIMAL(14,2))"
    )
    gap = spark.sql("SELECT 1 AS municipality_code, 7L AS n_units_contracted, 30 AS fjp_deficit, 0.2333D AS coverage_fjp")
    predictions = spark.sql("SELECT 1 AS municipality_code, 0.1D AS relative_deficit_forecast, 12D AS deficit_forecast_units")
    allocated = spark.sql("SELECT 1 AS municipality_code, 3L AS allocated_units, 900D AS investment")
    built = build_profiles(precarious, gap, predictions, allocated, 5)
    rows = {r._id: r.asDict(recursive=True) for r in built.collect()}
    assert rows[1]["cadunico"]["deficit_rate"] == 0.25 and rows[1]["reference_date"] == "2026-09-11"
    assert rows[2]["cadunico"]["families_in_deficit"] is None and rows[2]["cadunico"]["deficit_rate"] is None
    assert rows[2]["cadunico"]["families"] == 40 and rows[2]["cadunico"]["precariousness_index"] is None
    assert rows[2]["disclosure_control"] == {"min_cell_size": 5, "suppressed_fields": ["n_families_deficit", "deficit_rate"]}
    assert rows[2]["service"] == {"units_contracted": None, "fjp_deficit": None, "fjp_coverage": None}
    assert list(rows[1]) == ["_id", "municipality", "reference_date", "cadunico", "service", "forecast", "allocation",
                             "disclosure_control", "updated_at"]
    assert tuple(profiles_with_suppression(built).first()) == (2, 1)

    table = str(tmp_path / "profiles")
    assert publish(built, table) == {"inserted": 2, "updated": 0}
    assert publish(built, table) == {"inserted": 0, "updated": 0}
    changed = build_profiles(precarious, gap.withColumn("fjp_deficit", F.lit(31)), predictions, allocated, 5)
    assert publish(changed, table) == {"inserted": 0, "updated": 1}


# -- whole jobs ---------------------------------------------------------------------------


def two_row_family(spark):
    contracts = spark.sql("SELECT 'p' AS cpf_pseudo, 'FAR' AS program, 1 AS municipality_code, 100L AS declared_income, 1 AS income_band")
    persons = spark.sql("SELECT 'p' AS cpf_pseudo, 7L AS family_id, 1L AS person_id, DATE '2026-01-01' AS _reference_date")
    home = "0 AS {}"
    zeros = ", ".join(home.format(c) for c in ("wall_material", "expense_rent", "people_in_dwelling", "bedrooms", "piped_water", "has_bathroom", "sewage_disposal", "garbage_disposal", "lighting", "floor_material"))
    rows = [(1, 1, 9000), (1, 2, 10), (2, 1, 20), (1, 1, "NULL")]
    families = spark.sql(" UNION ALL ".join(f"SELECT 7L AS family_id, {d} AS dwelling_kind, {n} AS families_in_dwelling, {i} AS total_income, {zeros}" for d, n, i in rows))
    return contracts, persons, families, {1: 2850}


def test_crosswalk_takes_all_rows_of_a_family(spark):
    row = marts.crosswalk(*two_row_family(spark)).collect()
    assert [(r.cadunico_income, r.deficit_component, r.cadunico_income_above_band) for r in row] == [(9000, "precarious_housing", True)]


def test_targeting_counts_a_contract_once(spark):
    row = marts.targeting(marts.crosswalk(*two_row_family(spark))).first()
    assert (row.n_contracts, row.n_family_in_deficit, row.n_cadunico_income_above_band) == (1, 1, 1)


def test_publish_counts_quarantined_rows(spark, tmp_path):
    line = "SELECT {0}L AS l_orderkey, 1L AS l_partkey, 1L AS l_suppkey, {1} AS l_linenumber, 3D AS l_quantity, 10.5D AS l_extendedprice, 0.1D AS l_discount, 0D AS l_tax, '{2}' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP '{3}-01-01 00:00:00' AS l_shipdate"
    lines = [(1, 1, "A", 1999), (1, 1, "A", 1998), (2, 3, "N", 2020), (3, 4, "R", 1997)]
    spark.sql(" UNION ALL ".join(line.format(*x) for x in lines)).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT 1L AS s_suppkey, 5D AS s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    found = checking.silver_publish(spark, str(tmp_path)).collect()
    assert sorted((r.flag, r.n_rows, r.n_valid, r.n_lines) for r in found) == [("A", 2, 1, 1), ("N", 1, 0, 0), ("R", 1, 1, 1)]
