"""Option-dictionary entry points give the same results as the typed operators."""

from __future__ import annotations

from lakeshift import config
from lakeshift.operators.scd2 import scd2_keys, upsert
from compare import digest
from lakeshift.plans.frames import frame
from lakeshift.sinks.writers import BULK_FORMAT, mart_write_plan

from conftest import SF_SMALL


def rows(df):
    return digest(df.columns, [tuple(r) for r in df.collect()])


def test_upsert_batch_matches_typed_call(spark):
    sat, upd = frame(spark, SF_SMALL, "sat"), frame(spark, SF_SMALL, "upd")
    obj = {"target-table": "vault.SAT_ORDER", "source-filter": "F", "scd2": {"target-table-keys": ["ORD_ID"],
           "scd2-column": {"b": {"colName": "VAL"}}}}
    ins = ["ORD_ID", "REF_ID", "REC_SRC_NM", "PART_COL", "LD_DT", "BTCH_DT", "LD_END_DT", "VAL", "rankColumn"]
    got = config.upsert_batch(sat, upd, obj, "LD_END_DT", ins)
    want = upsert(sat, upd, scd2_keys(obj["scd2"], upd.columns), "LD_END_DT", ins, scd2_columns=["VAL"],
                  source_filter="F")
    assert rows(got) == rows(want)
    hist = dict(obj, historicalFlag="true")
    got = config.upsert_batch(sat, upd, hist, "LD_END_DT", ins)
    want = upsert(sat, upd, scd2_keys(obj["scd2"], upd.columns), "LD_END_DT", ins, scd2_columns=["VAL"],
                  historical_sat=True, source_filter="F")
    assert rows(got) == rows(want)


def test_read_vault_table_and_cycle(spark, tmp_path):
    sat = frame(spark, SF_SMALL, "sat")
    root = str(tmp_path)
    sat.write.parquet(f"{root}/VAULT/sat_order")
    obj = {"read-type": "rec-source-filtered-active", "source-filter": "O"}
    got = config.read_vault_table(spark, root, "vault.SAT_ORDER", obj)
    assert got.count() == sat.where("REC_SRC_NM = 'O' AND LD_END_DT IS NULL").count()
    cyc = frame(spark, SF_SMALL, "cycle")
    full = config.read_cycle_table(cyc, {"read-type": "full", "batchDate": "19990101"}, year_col="CYC_YEAR",
                                   month_col="CYC_MONTH")
    assert full.count() == cyc.where("CYC_YEAR = 99").count()


def test_lookup_values(spark):
    ref = frame(spark, SF_SMALL, "ref")
    got = config.lookup_values(ref, {"ref-look-up-values": {"SEG": "building"}, "return-look-up-col": "VAL",
                                     "return-look-up-col-const": {"length": 5, "rpad": "0"}})
    vals = [r.VAL for r in got.collect()]
    assert vals and all(len(v) >= 5 for v in vals)


def test_expire_and_historical_batches(spark):
    sat, upd = frame(spark, SF_SMALL, "sat"), frame(spark, SF_SMALL, "upd")
    obj = {"source-filter": "F", "update-keys": {"key-list": ["ORD_ID"], "cols-to-update": ["LD_END_DT", "X"]},
           "scd2": {"target-table-keys": ["ORD_ID"]}, "historicalFlag": "true", "sourceName": "ERP"}
    src = upd.where("ORD_ID IS NOT NULL")
    out = config.expire_batch(sat, src, obj, "LD_END_DT", ["ORD_ID", "REC_SRC_NM", "LD_DT", "BTCH_DT"])
    assert out.count() >= sat.count()
    upd_hist = config.update_historical_batch(sat, upd, obj, ["VAL"], batch_key_sources=["erp"])
    assert upd_hist.count() == sat.count()


def test_mart_write_plan():
    fmt, opts, mode = mart_write_plan("jdbc:x", "dbo.fact_a", mode="overwrite")
    assert (fmt, opts["numPartitions"], mode) == ("jdbc", "10", "overwrite")
    fmt, opts, mode = mart_write_plan("jdbc:x", "mart.fact_a", mode="overwrite")
    assert (fmt, opts["batchsize"], opts["tableLock"], mode) == (BULK_FORMAT, "100000", "true", "append")


def test_raw_and_clean_from_config(spark, tmp_path):
    raw_base, clean_base = str(tmp_path / "raw"), str(tmp_path / "clean")
    folder = tmp_path / "raw" / "crm" / "sales" / "cust"
    folder.mkdir(parents=True)
    (folder / "cust_20240102.csv").write_text("id|full name\n1|Ann\n2|Bo\n")
    obj = {"azure": {"raw-base-path": raw_base, "clean-base-path": clean_base}, "sourceName": "crm",
           "schemaName": "sales", "tableName": "cust", "batchDate": "20240102", "fileName": ""}
    df = config.read_raw_file(spark, obj, {"file-format": "csv", "header": "true", "delimiter": "|"})
    assert df.columns == ["id", "full_name"]
    path = config.write_clean_zone(df, obj)
    assert path.endswith("/crm/sales/cust/20240102")
    assert spark.read.parquet(path).count() == 2


def test_use_case_overlay():
    app = {"rec-source-list": ["A"], "DataVault": {"rec-source-list": ["B", "C"]}, "DataMart": {"x": 1}}
    assert config.rec_source_list(app, {"use-case": "Data-Vault"}) == ["B", "C"]
    assert config.rec_source_list(app, {"use-case": "datamart"}) == ["A"]
    assert config.overlay_use_case(app, {"use-case": "Datamart"})["x"] == 1
    assert config.rec_source_list({}, None) == []


def test_upsert_into_table_matches_in_memory(spark, tmp_path):
    sat, upd = frame(spark, SF_SMALL, "sat"), frame(spark, SF_SMALL, "upd")
    root = str(tmp_path)
    obj = {"target-table": "vault.SAT_ORDER", "source-filter": "F", "scd2": {"target-table-keys": ["ORD_ID"]}}
    config.write_vault_table(sat, root, obj)
    ins = ["ORD_ID", "REF_ID", "REC_SRC_NM", "PART_COL", "LD_DT", "BTCH_DT", "LD_END_DT", "VAL", "rankColumn"]
    config.upsert_into_table(spark, root, upd, obj, "LD_END_DT", ins, schema=sat.schema)
    stored = spark.read.schema(sat.schema).parquet(f"{root}/VAULT/sat_order").select(sat.columns)
    assert rows(stored) == rows(config.upsert_batch(sat, upd, obj, "LD_END_DT", ins))


def test_expire_and_historical_into_table(spark, tmp_path):
    sat, upd = frame(spark, SF_SMALL, "sat"), frame(spark, SF_SMALL, "upd")
    obj = {"target-table": "vault.SAT_ORDER", "source-filter": "F", "scd2": {"target-table-keys": ["ORD_ID"]},
           "update-keys": {"key-list": ["ORD_ID"], "cols-to-update": ["LD_END_DT", "SRC_EXPRN_DT"]},
           "historicalFlag": "true"}
    src = upd.where("ORD_ID IS NOT NULL")
    ins = ["ORD_ID", "REC_SRC_NM", "PART_COL", "LD_DT", "BTCH_DT", "SRC_EFF_DT", "LD_END_DT", "VAL"]
    for name, into, mem in [
        ("a", lambda r: config.expire_into_table(spark, r, src, obj, "LD_END_DT", ins, schema=sat.schema),
         lambda: config.expire_batch(sat, src, obj, "LD_END_DT", ins)),
        ("b", lambda r: config.update_historical_into_table(spark, r, upd, obj, ["VAL"], schema=sat.schema),
         lambda: config.update_historical_batch(sat, upd, obj, ["VAL"])),
    ]:
        root = str(tmp_path / name)
        config.write_vault_table(sat, root, obj)
        into(root)
        stored = spark.read.schema(sat.schema).parquet(f"{root}/VAULT/sat_order").select(sat.columns)
        assert rows(stored) == rows(mem())
