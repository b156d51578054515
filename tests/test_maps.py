"""Map naming and identity: batch duplicates, free names, series letters."""

from genospark.operators import maps

REC = "upload_id string, line_no long, snp_name string"
CAT = "map_name string, number_snp int, map_alias string"
SNP = "map_name string, id long, snp_name string"


def _records(spark, uploads):
    rows = [(u, i, n) for u, names in uploads.items() for i, n in enumerate(names)]
    return spark.createDataFrame(rows, REC)


def _run(spark, uploads, catalog_rows, snp_rows):
    rec = _records(spark, uploads)
    checks = maps.name_checks(rec)
    cat = spark.createDataFrame(catalog_rows, CAT)
    snps = spark.createDataFrame(snp_rows, SNP)
    out = maps.name_uploads(rec, checks, cat, snps).collect()
    return {r["upload_id"]: (r["code"], r["map_name"]) for r in out}


def test_batch_duplicates_and_series(spark):
    uploads = {
        "u1": ["A", "B"],          # new size 2 -> 2_a (m_E)
        "u2": ["B", "A"],          # same set as u1 -> m_D, named like u1
        "u3": ["C", "D"],          # same size, other names -> 2_b (m_F)
        "u4": ["X", "Y", "Z"],     # identical to catalogued 3_a -> m_D
        "u5": ["X", "Y", "W"],     # size 3, series has 3_a -> 3_b (m_F)
    }
    got = _run(spark, uploads, [("3_a", 3, "CHIP")],
               [("3_a", 1, "X"), ("3_a", 2, "Y"), ("3_a", 3, "Z")])
    assert got == {"u1": ("m_E", "2_a"), "u2": ("m_D", "2_a"), "u3": ("m_F", "2_b"),
                   "u4": ("m_D", "3_a"), "u5": ("m_F", "3_b")}


def test_series_goes_on_after_z(spark):
    catalog = [(f"1_{chr(97 + i)}", 1, f"C{i}") for i in range(25)]
    snps = [(f"1_{chr(97 + i)}", 1, f"N{i}") for i in range(25)]
    got = _run(spark, {"u1": ["f1"], "u2": ["f2"], "u3": ["f3"]}, catalog, snps)
    assert got == {"u1": ("m_F", "1_z"), "u2": ("m_F", "1_aa"), "u3": ("m_F", "1_ab")}


def test_free_names_fill_gaps(spark):
    catalog = [("3_b", 3, None), ("3_d", 3, None), ("2_ICAR", 2, None), ("2", 2, None), ("4_c", 9, None)]
    uploads = {"u1": ["A", "B", "C"], "u2": ["A", "B", "D"], "u3": ["A", "B", "E"], "v1": ["A", "B"],
               "w1": ["A", "B", "C", "D"]}
    got = _run(spark, uploads, catalog, [("3_b", 1, "X")])
    assert got == {"u1": ("m_F", "3_a"), "u2": ("m_F", "3_c"), "u3": ("m_F", "3_e"), "v1": ("m_F", "2_a"),
                   "w1": ("m_E", "4_a")}


def test_series_letters_and_back(spark):
    slots = spark.createDataFrame([(k,) for k in (0, 25, 26, 51, 701, 702, 18277, 18278)], "slot long")
    rows = slots.withColumn("text", maps.series_letters(slots["slot"]))
    got = rows.withColumn("back", maps.series_slot(rows["text"])).collect()
    assert [r.text for r in got] == ["a", "z", "aa", "az", "zz", "aaa", "zzz", "aaaa"]
    assert all(r.slot == r.back for r in got)


def test_name_checks(spark):
    rec = _records(spark, {"dup": ["A", "A", "B"], "blank": ["A", ""], "ok": ["A", "B"]})
    got = {r["upload_id"]: (r["has_dup"], r["n_blank"], r["verdict"]) for r in maps.name_checks(rec).collect()}
    assert got == {"dup": (True, 0, "m_A"), "blank": (False, 1, "m_A"), "ok": (False, 0, "ok")}
