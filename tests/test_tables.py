from genospark.sources import tables


def test_readers_prune_and_filter(spark, tmp_path):
    q = spark.createDataFrame([(1, None, 7, "G", "G_1.zip", 0, "extra")],
                              "Nume_Cari long, Data_Cari timestamp, User_Cari long, Tipo_Cari string, "
                              "Nome_file string, bit_elaborato int, Other string")
    q.write.parquet(str(tmp_path / "queue"))
    df = tables.read_queue(spark, str(tmp_path / "queue"))
    assert df.columns == ["nume_cari", "data_cari", "user_cari", "tipo_cari", "nome_file", "bit_elaborato"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Other" not in plan.split("ReadSchema")[-1]
    m = spark.createDataFrame([("a", 1, "S1"), ("b", 1, "S2")], "map_name string, id long, snp_name string")
    m.write.partitionBy("map_name").parquet(str(tmp_path / "maps"))
    got = tables.read_snp_maps(spark, str(tmp_path / "maps"), ["b"])
    assert [r["snp_name"] for r in got.collect()] == ["S2"]
    assert "PartitionFilters: [isnotnull(map_name" in got._jdf.queryExecution().executedPlan().toString()
