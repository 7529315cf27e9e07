"""The two date helpers as SQL functions, for callers who write SQL text."""

from pyspark.sql import DataFrame, SparkSession


def register_sql_functions(spark: SparkSession, base_year: int = 2014, years: int = 3) -> None:
    """Temporary SQL functions ``date_diff_units`` and ``get_index``; they are inlined by Catalyst."""
    units = ("timestampdiff(SECOND, from_ts, to_ts) / "
             "CASE unit WHEN 'Month' THEN 2592000 ELSE 3600 END")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION date_diff_units(
            to_ts TIMESTAMP_NTZ, from_ts TIMESTAMP_NTZ, unit STRING)
        RETURNS BIGINT
        RETURN CASE WHEN {units} > 0 THEN ceil({units}) ELSE floor({units}) END""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION get_index(created TIMESTAMP_NTZ)
        RETURNS STRING
        RETURN CASE WHEN year(created) BETWEEN {base_year} AND {base_year + years - 1}
            THEN CAST((year(created) - {base_year}) * 3 + ceil(month(created) / 4) AS STRING) END""")


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make results available to SQL text under their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
