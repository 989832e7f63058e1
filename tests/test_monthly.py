"""The monthly job on small files: run once, inspected by several tests."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from cartulary.operators.disclosure import leak_scan
from cartulary.operators.quality import RejectionLimitExceeded
from cartulary.plans.audit import read_runs, run_report
from cartulary.plans.forecast import TreeSettings
from cartulary.plans.ingest import apply_retention, ingest
from cartulary.plans.lake import Lake, Parameters
from cartulary.plans.monthly import (
    build_marts,
    forecast_and_allocate,
    ingest_all,
    publish_profiles,
    refine_all,
)
from cartulary.sources.delimited import LayoutDrift
from cartulary.sources.layouts import FAMILY, MUNICIPALITIES, Feed
from cartulary.sources.storage import read_partitioned, read_table
from tests.fixture_files import write_inbox

KEY = "test key with at least 32 characters!!"
PARTS = Feed(MUNICIPALITIES, "MUNICIPIOS_*.csv")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("monthly")
    write_inbox(root / "inbox")
    lake = Lake(str(root / "lake"))
    assert ingest_all(spark, lake, str(root / "inbox"), "run-1") == 8
    refine_all(spark, lake, "run-1", KEY)
    build_marts(spark, lake, "run-1")
    forecast_and_allocate(spark, lake, "run-1", settings=TreeSettings(iterations=2))
    return lake


def silver(spark, lake, name):
    return read_table(spark, lake.path("silver", name))


def test_every_step_is_logged(spark, lake):
    runs = read_runs(spark, lake)
    assert {r.status for r in runs.select("status").distinct().collect()} == {"success"}
    steps = {(r.stage, r.table_name): r["count"] for r in runs.groupBy("stage", "table_name").count().collect()}
    assert steps[("bronze", "cadunico_family")] == 2 and steps[("silver", "cadunico_person")] == 2
    assert steps[("silver", "mcmv_beneficiaries")] == 1 and steps[("ml", "unit_allocation")] == 1
    family = runs.where("stage = 'silver' AND table_name = 'cadunico_family'").orderBy("reference_date").collect()
    first, second = (json.loads(r.details) for r in family)
    # 402 lines: negative income, unknown place, bad date, short row and the older copy are rejected
    assert (family[0].rows_in, family[0].rows_quarantined, first["rows_inserted"]) == (402, 5, 397)
    # 20 newer rows, three of them rejected in month one and so new now, and 10 new families
    assert (second["rows_inserted"], second["rows_updated"]) == (13, 17)
    volume = runs.where("stage = 'bronze' AND table_name = 'cadunico_family'").orderBy("reference_date").collect()
    assert "volume_change" not in json.loads(volume[0].details)
    assert json.loads(volume[1].details)["unusual_volume"] is True
    assert json.loads(volume[0].details)["corrupt_rows"] == 1
    assert run_report(runs).count() <= 30


def test_quarantine_reasons_without_raw_text(spark, lake):
    kept = read_partitioned(spark, lake.path("quarantine", "cadunico_family"))
    reasons = {r[0] for r in kept.select(F.explode("_failures")).distinct().collect()}
    assert {"layout_valid", "income_non_negative", "municipality_valid", "update_date_valid", "unique_record"} <= reasons
    assert not {"_corrupt_record", "_record_hash", "_file_key", "no_logradouro_fam"} & set(kept.columns)
    people = read_partitioned(spark, lake.path("quarantine", "cadunico_person"))
    assert {"age_valid", "person_id_present"} <= {r[0] for r in people.select(F.explode("_failures")).collect()}
    metrics = read_partitioned(spark, lake.path("audit", "quality"))
    assert metrics.where("table_name = 'cadunico_family' AND rule = 'types_valid'").agg(F.sum("failures")).first()[0] == 3


def test_silver_columns(spark, lake):
    families = silver(spark, lake, "cadunico_family")
    kept = [f.target for f in FAMILY.fields if f.action != "drop"]
    assert set(families.columns) == {
        *kept, "per_capita_income", "_reference_date", "_source_file", "_warnings", "_run_id",
    }
    assert families.count() == 410 and families.select("family_id").distinct().count() == 410
    assert families.where("zip_prefix = '70000'").count() > 0
    contracts = silver(spark, lake, "mcmv_beneficiaries")
    assert {r[0] for r in contracts.select("program").distinct().collect()} <= {"FAR", "FDS", "PNHR", "FGTS"}
    assert {r[0] for r in contracts.select("_reference_date").distinct().collect()} == {datetime.date(2026, 9, 11)}


def test_nothing_leaks(spark, lake):
    people = read_partitioned(spark, lake.path("bronze", "cadunico_person"))
    forbidden = people.select("NO_PESSOA").union(people.select("NU_CPF_PESSOA"))
    tables = [silver(spark, lake, n) for n in ("cadunico_family", "cadunico_person", "mcmv_beneficiaries")]
    tables += [read_partitioned(spark, lake.path("quarantine", "cadunico_person"))]
    tables += [read_table(spark, lake.path("gold", "review_flags"))]
    for df in tables:
        assert leak_scan(df, forbidden).count() == 0


def test_gold(spark, lake):
    gold = lambda name: read_table(spark, lake.path("gold", name))
    precarious = gold("municipality_precariousness")
    assert precarious.where("precariousness_index IS NULL OR deficit_rate NOT BETWEEN 0 AND 1").count() == 0
    registered = silver(spark, lake, "cadunico_family").where("registry_status = 3").count()
    assert precarious.agg(F.sum("n_families")).first()[0] == registered
    contracts, linked = gold("mcmv_targeting").agg(F.sum("n_contracts"), F.sum("n_in_cadunico")).first()
    assert 0 < linked < contracts
    assert gold("review_flags").where("array_contains(reasons, 'multiple_contracts')").count() == 2
    assert gold("service_gap").count() == 30 and gold("deficit_forecast").count() == 30
    allocated = gold("unit_allocation")
    assert allocated.agg(F.sum("investment")).first()[0] <= Parameters().budget
    assert allocated.where("allocated_units > capacity").count() == 0
    counts = publish_profiles(spark, lake, "run-1", lake.path("gold", "profiles"))
    assert counts == {"inserted": 30, "updated": 0}
    assert publish_profiles(spark, lake, "run-2", lake.path("gold", "profiles")) == {"inserted": 0, "updated": 0}


def test_second_run_changes_nothing(spark, lake):
    inbox = lake.root.replace("/lake", "/inbox")
    before = {n: silver(spark, lake, n).count() for n in ("cadunico_family", "cadunico_person", "mcmv_beneficiaries")}
    assert ingest_all(spark, lake, inbox, "run-2") == 2  # only the two reference files
    refine_all(spark, lake, "run-2", KEY)
    again = read_runs(spark, lake).where("run_id = 'run-2'")
    assert again.where("status = 'skipped'").count() == 6
    assert again.where("stage = 'silver' AND table_name LIKE 'cadunico%'").count() == 0
    assert {n: silver(spark, lake, n).count() for n in before} == before


def test_reprocessed_snapshot_is_due_again(spark, lake):
    inbox = lake.root.replace("/lake", "/inbox")
    assert ingest(spark, lake, "cadunico_family", inbox, "run-3", reprocess=True) == 2
    refine_all(spark, lake, "run-3", KEY)
    again = read_runs(spark, lake).where("run_id = 'run-3' AND stage = 'silver' AND table_name = 'cadunico_family'")
    assert again.count() == 2
    assert silver(spark, lake, "cadunico_family").count() == 410


def test_files_of_one_date_form_one_snapshot(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    lake = Lake(str(tmp_path / "lake"))
    part = lambda name, first: (inbox / f"MUNICIPIOS_01012026_{name}.csv").write_text(
        "\n".join([";".join(PARTS.layout.names), *(f"{n};M;UF;1;R;1;1" for n in range(first, first + 3))]) + "\n"
    )
    part("A", 0)
    assert ingest(spark, lake, "parts", str(inbox), "r1", feed=PARTS) == 1
    part("B", 10)
    assert ingest(spark, lake, "parts", str(inbox), "r2", feed=PARTS) == 2
    assert ingest(spark, lake, "parts", str(inbox), "r3", feed=PARTS) == 0
    rows = read_partitioned(spark, lake.path("bronze", "parts"))
    assert rows.count() == 6 and rows.select("_source_file").distinct().count() == 2
    # a snapshot that comes back empty leaves no old rows
    for name in "AB":
        (inbox / f"MUNICIPIOS_01012026_{name}.csv").write_text(";".join(PARTS.layout.names) + "\n")
    assert ingest(spark, lake, "parts", str(inbox), "r4", reprocess=True, feed=PARTS) == 2
    assert read_partitioned(spark, lake.path("bronze", "parts")).count() == 0


def test_header_drift_stops_the_load(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    lake = Lake(str(tmp_path / "lake"))
    names = list(FAMILY.names)
    (inbox / "ARQ_FAMILIA_01012026_A.TXT").write_text(";".join(reversed(names)) + "\n")
    with pytest.raises(LayoutDrift, match="wrong order"):
        ingest(spark, lake, "cadunico_family", str(inbox), "r")
    (inbox / "ARQ_FAMILIA_01012026_A.TXT").write_text(";".join(["X", *names[1:]]) + "\n")
    with pytest.raises(LayoutDrift, match="missing.*CD_IBGE_CADASTRO.*unexpected.*X"):
        ingest(spark, lake, "cadunico_family", str(inbox), "r")
    (inbox / "ARQ_FAMILIA_01012026_A.TXT").rename(inbox / "ARQ_FAMILIA_NODATE.TXT")
    with pytest.raises(LayoutDrift, match="no DDMMYYYY"):
        ingest(spark, lake, "cadunico_family", str(inbox), "r")
    assert {r.status for r in read_runs(spark, lake).collect()} == {"failed"}


def test_rejection_limit_stops_publishing(spark, tmp_path):
    write_inbox(tmp_path / "inbox", families=80)
    lake = Lake(str(tmp_path / "lake"))
    ingest_all(spark, lake, str(tmp_path / "inbox"), "r")
    with pytest.raises(RejectionLimitExceeded, match="unique_record|income|layout"):
        refine_all(spark, lake, "r", KEY, Parameters(max_rejection_rate=0.01))
    failed = read_runs(spark, lake).where("status = 'failed'").first()
    assert failed.table_name == "cadunico_family" and "RejectionLimitExceeded" in failed.error
    # metrics and quarantine were written before the stop
    assert read_partitioned(spark, lake.path("quarantine", "cadunico_family")).count() == 5
    assert read_partitioned(spark, lake.path("audit", "quality")).where("table_name = 'cadunico_family'").count() > 0


def test_retention(spark, lake):
    apply_retention(spark, lake, "run-9", months=1, today=datetime.date(2026, 10, 20))
    left = read_partitioned(spark, lake.path("bronze", "cadunico_family"))
    assert {r[0] for r in left.select("_reference_date").distinct().collect()} == {datetime.date(2026, 9, 11)}
    logged = read_runs(spark, lake).where("run_id = 'run-9' AND table_name = 'cadunico_family'").first()
    assert logged.rows_out == 402 and json.loads(logged.details)["cutoff"] == "2026-09-01"


def test_a_later_part_joins_one_that_has_left(spark, tmp_path):
    inbox, lake = tmp_path / "inbox", Lake(str(tmp_path / "lake"))
    inbox.mkdir()
    feed = Feed(MUNICIPALITIES, "PART*.csv", dated=True)
    header = feed.separator.join(feed.layout.names)
    for part in "12":
        (inbox / f"PART{part}_01012026.csv").write_text(f"{header}\n" + feed.separator.join([part] * len(feed.layout.names)) + "\n")
        assert ingest(spark, lake, "parts", str(inbox), f"run-{part}", feed=feed) == 1
        (inbox / f"PART{part}_01012026.csv").unlink()
    rows = read_partitioned(spark, lake.path("bronze", "parts"))
    assert sorted(r._source_file for r in rows.collect()) == ["PART1_01012026.csv", "PART2_01012026.csv"]
