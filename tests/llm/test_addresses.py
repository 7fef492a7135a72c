from pyspark.sql import SparkSession

from docloom.llm.addresses import locations


def test_addresses_without_a_settlement():
    spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
    rows = ["123456, ул. Лесная, д. 5, кв. 7", "123456, ул. Лесная, д. 5, кв. 7", "123456, ул. Лесная, д. 5, кв. 8", "ул. Речная, д. 9", "ул. Речная, д. 9", "ул. Речная, д. 10"]
    got = {r.record_id: r.location for r in locations(spark.createDataFrame(list(enumerate(rows)), "record_id bigint, address string")).collect()}
    assert got[0] == got[1] != got[2] and got[3] == got[4] != got[5] and len(set(got.values())) == 4
