from period_etl import read_stage
from period_etl.plans.config_run import load_config, run_config


def test_config_paths_and_tables(spark, trips, scratch, tmp_path):
    data = tmp_path / "data"
    ingest = data / "ingest" / "trips"
    trips.coalesce(1).write.parquet(f"{ingest}/trips_2025-01.parquet")
    toml = tmp_path / "config.toml"
    toml.write_text(f'''
log_file_dir = "logs"
data_dir = "{data}"
download_data = false
[dataset]
data_id = "trips"
timestamp_column = "ts"
urls = ["https://example.invalid/trip-data/trips_2025-01.parquet"]
''')
    cfg = load_config(str(toml))
    assert cfg.entries == ["trips_2025-01.parquet"]
    result = run_config(spark, cfg)
    assert result.periods == ["2025-01"]
    assert str(cfg.storage.target("trips", "clean")) == f"{data}/clean/trips.parquet"
    a = {(str(r.date), r.total_trips) for r in read_stage(spark, cfg.storage, "trips", "analytics").collect()}
    assert a == {("2025-01-01", 2), ("2025-01-31", 1)}

    ns = "cfg_" + scratch.rsplit("-", 1)[-1]
    toml.write_text(toml.read_text() + f'''
[iceberg]
enabled = true
catalog_uri = "sqlite://unused.db"
warehouse_path = "{tmp_path}/wh"
namespace = "{ns}"
''')
    cfg = load_config(str(toml))
    run_config(spark, cfg)
    assert spark.table(f"{ns}.trips_clean").count() == 3
    assert spark.table(f"{ns}.trips_analytics").count() == 2
