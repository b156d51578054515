"""SNP-map uploads: name checks, identity against the catalogue, naming, registration.

Identity of two maps is set equality of their names.  Instead of joining every
new map with every same-size catalogued map, both sides get a signature
(count, sum of a 31-bit hash, xor of a 64-bit hash); only signature-equal pairs
are verified with an exact join.  Equal sets always have equal signatures, so
the result is exact; a collision is removed by the verification join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genospark.session import stored

def name_checks(records: DataFrame, key: str = "upload_id") -> DataFrame:
    """Per upload: rows, distinct names, blanks, duplicate flag, verdict (m_A or ok)."""
    per_name = records.groupBy(key, "snp_name").agg(F.count(F.lit(1)).alias("k"))
    agg = per_name.groupBy(key).agg(
        F.sum("k").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum(F.when(F.col("snp_name") == "", F.col("k")).otherwise(0)).alias("n_blank"),
        F.sum(F.when(F.col("snp_name").isNull(), F.col("k")).otherwise(0)).alias("n_null"))
    return agg.select(
        key, "n_rows", "n_distinct", "n_blank", "n_null",
        (F.col("n_rows") != F.col("n_distinct")).alias("has_dup"),
        F.when((F.col("n_rows") != F.col("n_distinct")) | (F.col("n_blank") > 0), "m_A")
         .otherwise("ok").alias("verdict"))


def signatures(records: DataFrame, key: str) -> DataFrame:
    h = F.xxhash64("snp_name")
    return records.groupBy(key).agg(
        F.count(F.lit(1)).cast("int").alias("n_snp"),
        F.sum(F.pmod(h, F.lit(2147483648))).alias("sig_sum"),
        F.bit_xor(h).alias("sig_xor"))


def catalogue_records(catalog: DataFrame, snp_maps: DataFrame) -> DataFrame:
    """(map_name, snp_name) of every catalogued map."""
    return snp_maps.join(catalog.select("map_name"), "map_name").select("map_name", "snp_name")


def _verify(pairs: DataFrame, left: DataFrame, right: DataFrame, lkey: str, rkey: str) -> DataFrame:
    """Keep pairs (lkey, rkey, n_snp) whose name sets are equal (names unique on both sides)."""
    lr = left.select(F.col(lkey).alias("_l"), "snp_name")
    rr = right.select(F.col(rkey).alias("_r"), "snp_name")
    # a few candidates per upload, stored: broadcast from their real size, else a skew-split join
    p = stored(pairs.select(F.col(lkey).alias("_l"), F.col(rkey).alias("_r"), "n_snp"), "pairs")
    matched = (lr.join(p.select("_l", "_r"), "_l")
               .join(rr, ["_r", "snp_name"])
               .groupBy("_l", "_r").agg(F.count(F.lit(1)).alias("n_matched")))
    return (p.join(matched, ["_l", "_r"]).where(F.col("n_matched") == F.col("n_snp"))
            .select(F.col("_l").alias(lkey), F.col("_r").alias(rkey), "n_snp"))


def identical_maps(new_records: DataFrame, catalog: DataFrame, snp_maps: DataFrame,
                   key: str = "upload_id", new_sig: DataFrame | None = None) -> DataFrame:
    """(upload, map_name, n_snp) for every new map whose names equal a catalogued map's.

    Only catalogued maps whose size equals a new upload's size are read (with
    ``snp_maps`` partitioned by map name, the semi join prunes partitions).
    """
    if new_sig is None:
        new_sig = stored(signatures(new_records, key), "signatures")
    sizes = new_sig.select(F.col("n_snp").alias("number_snp")).distinct()
    same_size = catalog.join(sizes, "number_snp", "left_semi")
    # one read of the same-size maps for signatures; the names of signature-equal maps alone are read again
    cat_sig = signatures(catalogue_records(same_size, snp_maps), "map_name")
    pairs = stored(new_sig.join(cat_sig, ["n_snp", "sig_sum", "sig_xor"]).select(key, "map_name", "n_snp"), "pairs")
    met = catalogue_records(same_size.join(pairs.select("map_name").distinct(), "map_name", "left_semi"), snp_maps)
    return _verify(pairs, new_records, met, key, "map_name")


def batch_duplicates(new_records: DataFrame, key: str = "upload_id", sig: DataFrame | None = None) -> DataFrame:
    """(upload, first_upload) for uploads whose names equal an earlier upload of the same batch.

    Each signature group is checked against its first upload only (a star,
    not all pairs), so the work stays linear in the group size.
    """
    if sig is None:
        sig = signatures(new_records, key)
    first = sig.groupBy("n_snp", "sig_sum", "sig_xor").agg(F.min(key).alias("first_upload"))
    members = (sig.join(first, ["n_snp", "sig_sum", "sig_xor"])
               .where(F.col(key) != F.col("first_upload")).select(key, "first_upload", "n_snp"))
    return _verify(members, new_records, new_records.withColumnRenamed(key, "first_upload"),
                   key, "first_upload").select(key, "first_upload")


def same_size_maps(checks: DataFrame, catalog: DataFrame, key: str = "upload_id") -> DataFrame:
    """Valid uploads joined to catalogued maps with the same SNP count (integer equality)."""
    ok = checks.where(F.col("verdict") == "ok").select(key, F.col("n_rows").cast("int").alias("n_snp"))
    return ok.join(catalog.withColumnRenamed("number_snp", "n_snp"), "n_snp").select(
        key, "n_snp", "map_name", "map_alias")


SERIES = r"^([0-9]+)_([a-z]+)$"


def series_slot(letters: Column) -> Column:
    """Place of a series suffix: a 0 .. z 25, aa 26, and so on."""
    place = F.aggregate(F.split(letters, ""), F.lit(0).cast("long"), lambda acc, x: acc * 26 + F.ascii(x) - 96)
    return place - 1


def series_letters(slot: Column) -> Column:
    """Inverse of ``series_slot``."""
    start = F.struct(slot.cast("long").alias("rest"), F.lit("").alias("text"))

    def step(acc, _):
        more = acc["rest"] >= 0
        return F.struct(
            F.when(more, F.expr("0L") + F.floor(acc["rest"] / 26) - 1).otherwise(acc["rest"]).alias("rest"),
            F.when(more, F.concat(F.chr(97 + acc["rest"] % 26), acc["text"])).otherwise(acc["text"]).alias("text"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(13)), start, step, lambda acc: acc["text"])


def free_slots(fresh: DataFrame, catalog: DataFrame) -> DataFrame:
    """(n_snp, rank, slot): for each size its free names, as many as it has new maps, in order.

    Only names of the size's own series take a slot.  Per size the candidates are its
    taken slots plus its new maps, so rows stay within catalogue plus uploads.
    """
    taken = (catalog.select(F.regexp_extract("map_name", SERIES, 1).alias("n"),
                            F.regexp_extract("map_name", SERIES, 2).alias("letters")).where("letters <> ''")
             .select(F.col("n").cast("int").alias("n_snp"), series_slot(F.col("letters")).alias("slot")).distinct())
    used = taken.groupBy("n_snp").agg(F.count(F.lit(1)).alias("n_taken"))
    need = fresh.groupBy("n_snp").agg(F.count(F.lit(1)).alias("n_new"))
    tried = (need.join(used, "n_snp", "left")
             .select("n_snp", "n_new", F.explode(F.sequence(
                 F.lit(0).cast("long"), F.col("n_new") + F.coalesce("n_taken", F.lit(0)) - 1)).alias("slot")))
    w = Window.partitionBy("n_snp").orderBy("slot")
    return (tried.join(taken, ["n_snp", "slot"], "left_anti")
            .select("n_snp", "slot", "n_new", F.row_number().over(w).alias("rank")).where("rank <= n_new")
            .select("n_snp", "rank", "slot"))


def assign_names(checks: DataFrame, catalog: DataFrame, identical: DataFrame,
                 duplicates: DataFrame, key: str = "upload_id") -> DataFrame:
    """Outcome and map name for every valid upload.

    m_D: identical to a catalogued map (or to an earlier upload of the batch);
    m_E: first map of a size that no catalogued map has; m_F: any other new map.  New maps
    get the free names of their size's series (``<n>_a`` .. ``<n>_z``, ``<n>_aa`` ..) in
    upload order.
    """
    ok = checks.where(F.col("verdict") == "ok").select(key, F.col("n_rows").cast("int").alias("n_snp"))
    ident = identical.groupBy(key).agg(F.min("map_name").alias("identical_to"))
    dup = duplicates.select(key, "first_upload")
    cand = stored(ok.join(ident, key, "left").join(dup, key, "left"), "candidates")
    fresh = cand.where(F.col("identical_to").isNull() & F.col("first_upload").isNull())
    # one row per upload: the window runs over the upload list, not over data lines
    w = Window.partitionBy("n_snp").orderBy(key)
    sizes = catalog.select(F.col("number_snp").alias("n_snp"), F.lit(True).alias("known")).distinct()
    named = (fresh.withColumn("rank", F.row_number().over(w))
             .join(free_slots(fresh, catalog), ["n_snp", "rank"]).join(sizes, "n_snp", "left")
             .select(key, "n_snp", F.concat(F.col("n_snp").cast("string"), F.lit("_"),
                                            series_letters(F.col("slot"))).alias("map_name"),
                     F.when(F.col("known").isNull() & (F.col("rank") == 1), "m_E").otherwise("m_F").alias("code")))
    fresh = stored(named, "named")
    first = fresh.select(F.col(key).alias("first_upload"), F.col("map_name").alias("first_name"))
    same = cand.where(F.col("identical_to").isNotNull()).select(
        key, "n_snp", F.col("identical_to").alias("map_name"), F.lit("m_D").alias("code"))
    batch = (cand.where(F.col("identical_to").isNull() & F.col("first_upload").isNotNull())
             .join(first, "first_upload")
             .select(key, "n_snp", F.col("first_name").alias("map_name"), F.lit("m_D").alias("code")))
    return fresh.unionByName(same).unionByName(batch)


def name_uploads(records: DataFrame, checks: DataFrame, catalog: DataFrame, snp_maps: DataFrame,
                 key: str = "upload_id") -> DataFrame:
    """Outcome (m_D/m_E/m_F/m_B) and map name of every upload that passed the name checks.

    ``records`` and ``checks`` should be stored tables (see ``map_outcomes``);
    the identity result is stored too, since both naming branches read it.
    """
    # checks and identical are stored tables: the planner broadcasts them from
    # their real file size (and shuffles beyond the threshold)
    valid = checks.where(F.col("verdict") == "ok").select(key)
    valid_records = records.join(valid, key, "left_semi")
    sig = stored(signatures(valid_records, key), "signatures")  # one pass, read by both checks
    identical = stored(identical_maps(valid_records, catalog, snp_maps, key, new_sig=sig))
    not_ident = valid_records.join(identical.select(key), key, "left_anti")
    dups = stored(batch_duplicates(not_ident, key, sig=sig.join(identical.select(key), key, "left_anti")))
    return assign_names(checks, catalog, identical, dups, key)


def map_outcomes(layout: DataFrame, records: DataFrame, catalog: DataFrame, snp_maps: DataFrame,
                 key: str = "upload_id") -> DataFrame:
    """(upload, code, map_name, n_snp) for every map upload, in rule order m_B, m_A, m_D, m_E/m_F.

    ``records`` is read by several branches (checks, signatures, verification
    joins): pass a stored table (``map_batch`` does).  The per-upload check
    table is written once too, so that each branch scans stored rows and the
    plan stays small.
    """
    checks = stored(name_checks(records, key))
    named = name_uploads(records, checks, catalog, snp_maps, key)
    base = layout.select(key, "header_ok").join(checks, key, "left")
    out = base.join(named, key, "left")
    return stored(out.select(
        key,
        F.when(~F.col("header_ok") | (F.col("n_null") > 0) | F.col("n_rows").isNull(), "m_B")
         .when(F.col("verdict") == "m_A", "m_A").otherwise(F.col("code")).alias("code"),
        F.when(F.col("header_ok") & (F.col("verdict") == "ok"), F.col("map_name")).alias("map_name"),
        F.col("n_rows").cast("int").alias("n_snp")))


def registrations(outcomes: DataFrame, records: DataFrame, key: str = "upload_id"):
    """New catalogue rows and SNP rows for uploads registered as E or F.

    Returns (catalog_rows, snp_rows), both with the registering upload; ids follow line order
    within the map.
    The alias stays null at registration and is filled by the alias update.
    """
    new = outcomes.where(F.col("code").isin("m_E", "m_F")).select(key, "map_name", "n_snp")
    cat_rows = new.select(F.col(key).alias("upload"), "map_name", F.col("n_snp").alias("number_snp"),
                          F.lit(None).cast("string").alias("map_alias"))
    w = Window.partitionBy(key).orderBy("line_no")  # one map per window group: bounded by map size
    snp_rows = (records.join(stored(new.select(key, "map_name"), "new-maps"), key)
                .select(F.col(key).alias("upload"), "map_name", F.row_number().over(w).cast("long").alias("id"),
                        "snp_name"))
    return cat_rows, snp_rows
