from starloom.__main__ import main
from starloom.plans.refresh import read_star
from starloom.sinks.staging import staging_path
from tests.fixtures import retail_fixture


def test_refresh_and_report_from_a_folder_of_source_tables(spark, capsys):
    src = retail_fixture(spark)
    source = staging_path(spark, "cli-source")
    for name, df in src.tables().items():
        df.write.parquet(f"{source}/{name}.parquet")
    target = staging_path(spark, "cli-target")
    assert main(["refresh", "--source", source, "--target", target,
                 "--as-of", "2024-12-31"]) == 0
    star = read_star(spark, target)
    assert star["fact_sales"].count() == 5
    assert star["fact_sales_monthly_snapshot"].count() == 3
    assert main(["report", "--target", target, "--limit", "2"]) == 0
    out = capsys.readouterr().out
    assert "fact_sales_monthly_snapshot" in out and "customer_name" in out
