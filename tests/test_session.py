import pytest

from repopulse import session
from repopulse.functions import sql


def test_clean_up_empties_the_folder(spark, tmp_path):
    path = session.shared_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert session.cut_lineage(spark.range(2)).count() == 2
    session.clean_up(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_views_by_name(spark):
    sql.register_views({"some_result": spark.range(2)})
    assert spark.sql("SELECT count(*) FROM some_result").first()[0] == 2
