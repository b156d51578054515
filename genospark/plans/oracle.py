"""Oracle SQL (DuckDB dialect) for every registered query with a SQL form.

Written independently of the Spark operators: where the Spark plan is clever
(gap filling, signatures, bitsets) the oracle is plain brute force.
"""

from __future__ import annotations

from genospark.plans.fixtures import duckdb_ctes

ORACLE: dict[str, str] = {}


def oracle(name: str, fixtures: list[str], body: str, extra_ctes: str = "", recursive: bool = False) -> None:
    head = duckdb_ctes(fixtures)
    if recursive:
        head = "WITH RECURSIVE " + head[len("WITH "):]
    if extra_ctes:
        head += ",\n" + extra_ctes.strip()
    ORACLE[name] = head + "\n" + body.strip()


# shared CTE pieces -----------------------------------------------------------

DECODE = ("CASE a1 || a2 WHEN 'BB' THEN 0 WHEN 'AB' THEN 1 WHEN 'AA' THEN 2 "
          "WHEN '--' THEN 5 END")


def _positions(map_name: str, s: str = "") -> str:
    return f"""
mp{s} AS (SELECT snp_key, CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS pos
       FROM (SELECT upper(snp_name) AS snp_key, min(id) AS id FROM fx_snp_map
             WHERE map_name = '{map_name}' GROUP BY 1) t),
msize{s} AS (SELECT CAST(count(*) AS INTEGER) AS n_snp FROM mp{s})"""


def _last(s: str = "") -> str:
    return f"""
dc{s} AS (SELECT c.*, upper(snp_name) AS snp_key, {DECODE} AS code FROM fx_calls c),
lc{s} AS (SELECT d.nume_cari, d.sample_id, m.pos, arg_max(d.code, d.line_no) AS code, max(d.line_no) AS line_no
       FROM dc{s} d JOIN mp{s} m ON m.snp_key = d.snp_key WHERE d.code IS NOT NULL GROUP BY 1, 2, 3)"""


def _strings(s: str = "") -> str:
    """Brute force: every (sample, position) cell, '5' where no call won."""
    return f"""
samples{s} AS (SELECT DISTINCT nume_cari, sample_id FROM fx_calls),
cells{s} AS (SELECT x.nume_cari, x.sample_id, m.pos, l.code FROM samples{s} x CROSS JOIN mp{s} m
          LEFT JOIN lc{s} l ON l.nume_cari = x.nume_cari AND l.sample_id = x.sample_id AND l.pos = m.pos),
gs{s} AS (SELECT nume_cari, sample_id,
              string_agg(coalesce(CAST(code AS VARCHAR), '5'), '' ORDER BY pos) AS genotype,
              CAST(sum(CASE WHEN code IN (0, 1, 2) THEN 1 ELSE 0 END) AS INTEGER) AS n_called
       FROM cells{s} GROUP BY 1, 2)"""


def _encoded(map_name: str, s: str = "") -> str:
    return _positions(map_name, s) + "," + _last(s) + "," + _strings(s)


_LAST = _last()

oracle("q23", ["fx_calls"], """
SELECT nume_cari,
       CAST(sum(CASE WHEN a1 IN ('A', 'B', '-') THEN 0 ELSE 1 END) AS BIGINT) AS n_bad_a1,
       CAST(sum(CASE WHEN a2 IN ('A', 'B', '-') THEN 0 ELSE 1 END) AS BIGINT) AS n_bad_a2,
       count(*) AS n_lines
FROM fx_calls GROUP BY nume_cari""")

oracle("q24", ["fx_calls"], f"""
SELECT nume_cari, line_no, sample_id, snp_name, a1 || a2 AS pair, {DECODE} AS code FROM fx_calls""")

oracle("q25", ["fx_calls", "fx_snp_map"], """
SELECT nume_cari, sample_id, pos, code, line_no FROM lc""", _positions("MAIN_a") + "," + _LAST)

oracle("q26", ["fx_calls", "fx_snp_map"], """
SELECT u.nume_cari, mp.snp_key AS snp_name, mp.pos
FROM (SELECT DISTINCT nume_cari FROM fx_calls) u CROSS JOIN mp
WHERE NOT EXISTS (SELECT 1 FROM fx_calls c WHERE c.nume_cari = u.nume_cari AND upper(c.snp_name) = mp.snp_key)""",
       _positions("MAIN_a"))

oracle("q27", ["fx_calls", "fx_snp_map"], f"""
SELECT nume_cari, snp_key AS snp_name,
       CASE WHEN bool_or(pos IS NULL) THEN 'not_in_map' ELSE 'undecodable' END AS reason
FROM (SELECT c.nume_cari, upper(c.snp_name) AS snp_key, mp.pos, {DECODE} AS code
      FROM fx_calls c LEFT JOIN mp ON mp.snp_key = upper(c.snp_name)) t
WHERE pos IS NULL OR code IS NULL GROUP BY 1, 2""", _positions("MAIN_a"))

oracle("q28", ["fx_calls", "fx_snp_map"], """
SELECT nume_cari, sample_id AS campione, round_even(n_called / n_snp, 4) AS callrate_g,
       'MAIN_a' AS mappa_usata_g, genotype AS genotipo
FROM gs CROSS JOIN msize""", _encoded("MAIN_a"))

oracle("q29", ["fx_calls", "fx_snp_map"], """
SELECT nume_cari, sample_id AS campione, n_snp, n_called, round_even(n_called / n_snp, 4) AS call_rate
FROM gs CROSS JOIN msize""", _encoded("MAIN_a"))

oracle("q30", ["fx_calls", "fx_snp_map"], f"""
SELECT gs.nume_cari, gs.sample_id AS campione, n_snp,
       coalesce(mi.n_missing, 0) AS n_missing, coalesce(un.n_not_in_map, 0) AS n_not_in_map,
       round_even(n_called / n_snp, 4) AS call_rate, 'MAIN_a' AS mappa_usata
FROM gs CROSS JOIN msize
LEFT JOIN (SELECT u.nume_cari, count(*) AS n_missing FROM (SELECT DISTINCT nume_cari FROM fx_calls) u CROSS JOIN mp
           WHERE NOT EXISTS (SELECT 1 FROM fx_calls c WHERE c.nume_cari = u.nume_cari AND upper(c.snp_name) = mp.snp_key)
           GROUP BY 1) mi ON mi.nume_cari = gs.nume_cari
LEFT JOIN (SELECT nume_cari, count(DISTINCT snp_key) AS n_not_in_map
           FROM (SELECT c.nume_cari, upper(c.snp_name) AS snp_key, mp.pos, {DECODE} AS code
                 FROM fx_calls c LEFT JOIN mp ON mp.snp_key = upper(c.snp_name)) t
           WHERE pos IS NULL OR code IS NULL GROUP BY 1) un ON un.nume_cari = gs.nume_cari""",
       _encoded("MAIN_a"))

oracle("q31", ["fx_calls", "fx_snp_map"], """
SELECT nume_cari, sample_id AS campione, genotype AS genotipo FROM gs""",
       _encoded("554_ICAR"))

oracle("q32", ["fx_calls", "fx_snp_map"], """
SELECT m.nume_cari, m.sample_id AS campione, round_even(m.n_called / n_snp, 4) AS callrate_g,
       'MAIN_a' AS mappa_usata_g, m.genotype AS genotipo, p.genotype AS genotipo_parentela
FROM gs m CROSS JOIN msize LEFT JOIN gsp p ON p.nume_cari = m.nume_cari AND p.sample_id = m.sample_id""",
       _encoded("MAIN_a") + "," + _encoded("554_ICAR", "p"))


# --------------------------------------------------------------------------
# queue
# --------------------------------------------------------------------------

_PENDING = "coalesce(bit_elaborato, -1) = 0"

oracle("q01", ["fx_jobs"], f"""
SELECT nume_cari, data_cari, user_cari, tipo_cari, nome_file, bit_elaborato FROM fx_jobs WHERE {_PENDING}""")

oracle("q02", ["fx_jobs"], f"""
SELECT nume_cari, nome_file, fn AS file_name, ends_with(fn, '.zip') AS is_zip,
       replace(fn, '.zip', '') AS output_name, replace(fn, '.zip', '') || '_ICAR' AS panel_output_name
FROM (SELECT *, CASE WHEN starts_with(nome_file, 'G_') THEN 'GEN_' || substr(nome_file, 3)
                     WHEN starts_with(nome_file, 'M_') THEN 'MAP_' || substr(nome_file, 3)
                     ELSE nome_file END AS fn
      FROM fx_jobs WHERE {_PENDING}) t""")

_TYPE_CODE = ("CASE WHEN tipo_cari = 'M' AND starts_with(first_line, '[Header]') THEN 'c_A' "
              "WHEN tipo_cari = 'G' AND NOT coalesce(starts_with(first_line, '[Header]'), false) THEN 'c_A' END")

oracle("q03", ["fx_jobs"], f"""
SELECT nume_cari, tipo_cari, CASE WHEN tipo_cari = 'M' THEN 'map' ELSE 'genotype' END AS route,
       {_TYPE_CODE} AS type_code
FROM fx_jobs WHERE {_PENDING}""")

# --------------------------------------------------------------------------
# parsing
# --------------------------------------------------------------------------

_WS = "' ' || chr(13) || chr(10)"
_SEPS = """
seps AS (SELECT * FROM (VALUES (0, chr(9)), (1, ','), (2, ' ' || chr(9)), (3, '-'), (4, ';')) t(priority, sep))"""

_REPORT = _SEPS + f""",
rfirst AS (SELECT nume_cari, arg_min(line, line_no) AS first_line FROM fx_raw_lines GROUP BY 1),
rhdr AS (SELECT nume_cari, trim(arg_min(line, line_no), {_WS}) AS header, min(line_no) AS hno
         FROM fx_raw_lines WHERE starts_with(line, 'SNP Name') GROUP BY 1),
rcnt AS (SELECT nume_cari, arg_min(line, line_no) AS content, min(line_no) AS cno
         FROM fx_raw_lines WHERE starts_with(line, 'Content') GROUP BY 1),
rsep AS (SELECT h.nume_cari, arg_min(s.sep, s.priority) AS sep FROM rhdr h, seps s
         WHERE list_contains(string_split(h.header, s.sep), 'SNP Name')
           AND list_contains(string_split(h.header, s.sep), 'Sample ID') GROUP BY 1),
rcsep AS (SELECT c.nume_cari, trim(c.content, {_WS}) AS content, arg_min(s.sep, s.priority) AS csep
          FROM rcnt c LEFT JOIN rhdr h USING (nume_cari), seps s
          WHERE (h.hno IS NULL OR c.cno < h.hno) AND len(string_split(trim(c.content, {_WS}), s.sep)) > 1 GROUP BY 1, 2),
rlay AS (SELECT f.nume_cari, f.first_line, h.hno AS header_line_no, s.sep,
                string_split(h.header, s.sep) AS hf,
                string_split(cs.content, cs.csep)[CASE WHEN cs.csep = chr(9) THEN 3 ELSE 2 END] AS chip
         FROM rfirst f LEFT JOIN rhdr h USING (nume_cari) LEFT JOIN rsep s USING (nume_cari)
         LEFT JOIN rcsep cs USING (nume_cari)),
rpos AS (SELECT *, list_position(hf, 'SNP Name') AS i_snp, list_position(hf, 'Sample ID') AS i_sample,
                list_position(hf, 'Allele1 - AB') AS i_a1, list_position(hf, 'Allele2 - AB') AS i_a2 FROM rlay),
rcalls AS (SELECT l.nume_cari, l.line_no, f[p.i_sample] AS sample_id, f[p.i_snp] AS snp_name,
                  f[p.i_a1] AS a1, f[p.i_a2] AS a2
           FROM (SELECT nume_cari, line_no, string_split(trim(line, {_WS}), sep) AS f
                 FROM fx_raw_lines JOIN rpos USING (nume_cari)
                 WHERE line_no > header_line_no AND trim(line, {_WS}) <> '') l
           JOIN rpos p USING (nume_cari)
           WHERE p.sep IS NOT NULL AND p.i_a1 IS NOT NULL AND p.i_a2 IS NOT NULL)"""

oracle("q04", ["fx_raw_lines"], "SELECT nume_cari, sep, header_line_no FROM rpos", _REPORT)
oracle("q13", ["fx_raw_lines"], "SELECT * FROM rcalls", _REPORT)
oracle("q14", ["fx_raw_lines"], "SELECT nume_cari, chip FROM rpos", _REPORT)
oracle("q15", ["fx_raw_lines"], """
SELECT nume_cari, sep, i_a1 IS NOT NULL AS has_a1, i_a2 IS NOT NULL AS has_a2,
       i_a1 IS NOT NULL AND i_a2 IS NOT NULL AS columns_ok FROM rpos""", _REPORT)

_MAPS_BODY = f"""
mup AS (SELECT DISTINCT upload_id FROM fx_map_lines),
mh AS (SELECT upload_id, trim(arg_min(line, line_no), {_WS}) AS header, min(line_no) AS hno
       FROM fx_map_lines WHERE starts_with(line, 'Index') GROUP BY 1),
ms AS (SELECT mh.upload_id, arg_min(s.sep, s.priority) AS sep FROM mh, seps s
       WHERE contains(mh.header, 'Name') AND list_contains(string_split(mh.header, s.sep), 'Index')
         AND list_contains(string_split(mh.header, s.sep), 'Name') GROUP BY 1),
mlay AS (SELECT u.upload_id, mh.hno, ms.sep, list_position(string_split(mh.header, ms.sep), 'Name') AS i_name
         FROM mup u LEFT JOIN mh USING (upload_id) LEFT JOIN ms USING (upload_id)),
mrec AS (SELECT l.upload_id, l.line_no, string_split(trim(l.line, {_WS}), m.sep)[m.i_name] AS snp_name
         FROM fx_map_lines l JOIN mlay m USING (upload_id)
         WHERE m.i_name IS NOT NULL AND l.line_no > m.hno AND trim(l.line, {_WS}) <> '')"""
_MAPS = _SEPS + "," + _MAPS_BODY

oracle("q05", ["fx_map_lines"], "SELECT upload_id, line_no, snp_name FROM mrec", _MAPS)

# --------------------------------------------------------------------------
# maps
# --------------------------------------------------------------------------


def _checks(src: str) -> str:
    return f"""
chk AS (SELECT upload_id, count(*) AS n_rows, count(DISTINCT snp_name) AS n_distinct,
               CAST(sum(CASE WHEN snp_name = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_blank,
               CAST(sum(CASE WHEN snp_name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null,
               count(*) <> count(DISTINCT snp_name) AS has_dup,
               CASE WHEN count(*) <> count(DISTINCT snp_name) OR sum(CASE WHEN snp_name = '' THEN 1 ELSE 0 END) > 0
                    THEN 'm_A' ELSE 'ok' END AS verdict
        FROM {src} GROUP BY 1)"""


# brute-force naming over a record source: identity by full name comparison
def _naming(src: str) -> str:
    return _checks(src) + f""",
cat AS (SELECT c.map_name, s.snp_name FROM fx_map_catalog c JOIN fx_map_snps s USING (map_alias)),
csize AS (SELECT map_name, count(*) AS n FROM cat GROUP BY 1),
vr AS (SELECT r.upload_id, r.snp_name FROM {src} r JOIN chk USING (upload_id) WHERE verdict = 'ok'),
vsize AS (SELECT upload_id, count(*) AS n FROM vr GROUP BY 1),
ident AS (SELECT m.upload_id, m.map_name, CAST(v.n AS INTEGER) AS n_snp
          FROM (SELECT vr.upload_id, cat.map_name, count(*) AS k FROM vr JOIN cat USING (snp_name) GROUP BY 1, 2) m
          JOIN vsize v USING (upload_id) JOIN csize c USING (map_name) WHERE m.k = v.n AND m.k = c.n),
rest AS (SELECT * FROM vsize WHERE upload_id NOT IN (SELECT upload_id FROM ident)),
pairs AS (SELECT a.upload_id AS u, b.upload_id AS v
          FROM (SELECT a.upload_id, b.upload_id AS other, count(*) AS k
                FROM vr a JOIN vr b ON a.snp_name = b.snp_name AND b.upload_id < a.upload_id
                WHERE a.upload_id IN (SELECT upload_id FROM rest) AND b.upload_id IN (SELECT upload_id FROM rest)
                GROUP BY 1, 2) p
          JOIN rest a ON a.upload_id = p.upload_id JOIN rest b ON b.upload_id = p.other
          WHERE p.k = a.n AND p.k = b.n),
dupl AS (SELECT u AS upload_id, min(v) AS first_upload FROM pairs GROUP BY 1),
fresh AS (SELECT r.upload_id, CAST(r.n AS INTEGER) AS n_snp,
                 coalesce(e.k, 0) + row_number() OVER (PARTITION BY r.n ORDER BY r.upload_id) - 1 AS slot
          FROM rest r LEFT JOIN (SELECT number_snp, count(*) AS k FROM fx_map_catalog GROUP BY 1) e ON e.number_snp = r.n
          WHERE r.upload_id NOT IN (SELECT upload_id FROM dupl)),
named AS (
  SELECT upload_id, n_snp, CASE WHEN slot < 26 THEN CAST(n_snp AS VARCHAR) || '_' || chr(CAST(97 + slot AS INTEGER)) END AS map_name,
         CASE WHEN slot >= 26 THEN 'm_B' WHEN slot = 0 THEN 'm_E' ELSE 'm_F' END AS code FROM fresh
  UNION ALL SELECT upload_id, n_snp, min(map_name), 'm_D' FROM ident GROUP BY 1, 2
  UNION ALL SELECT d.upload_id, CAST(v.n AS INTEGER), f.map_name, 'm_D'
            FROM dupl d JOIN vsize v USING (upload_id) JOIN fresh x ON x.upload_id = d.first_upload
            JOIN (SELECT upload_id, CAST(n_snp AS VARCHAR) || '_' || chr(CAST(97 + slot AS INTEGER)) AS map_name FROM fresh) f
              ON f.upload_id = d.first_upload)"""


oracle("q06", ["fx_new_map"], "SELECT upload_id, n_rows, n_distinct, has_dup FROM chk", _checks("fx_new_map"))
oracle("q07", ["fx_new_map"], "SELECT upload_id, n_blank FROM chk", _checks("fx_new_map"))
oracle("q08", ["fx_new_map"], "SELECT upload_id, n_rows AS n_snp, verdict FROM chk", _checks("fx_new_map"))
oracle("q09", ["fx_new_map", "fx_map_catalog"], """
SELECT c.upload_id, CAST(c.n_rows AS INTEGER) AS n_snp, m.map_name, m.map_alias
FROM chk c JOIN fx_map_catalog m ON m.number_snp = c.n_rows WHERE c.verdict = 'ok'""", _checks("fx_new_map"))
oracle("q10", ["fx_new_map", "fx_map_catalog", "fx_map_snps"], "SELECT upload_id, map_name, n_snp FROM ident",
       _naming("fx_new_map"))
oracle("q11", ["fx_new_map", "fx_map_catalog", "fx_map_snps"], "SELECT upload_id, n_snp, map_name, code FROM named",
       _naming("fx_new_map"))


# FIXED VALUES: the expected outcome rows, stated here apart from the engine's own table
_OUTCOME_ROWS = """
  ('c_A', 0, 1, 'Incorrect file type'),
  ('c_B', 0, 0, 'An error occurred. Please contact the system administrator.'),
  ('m_A', 0, 1, 'Error with the map'),
  ('m_B', 0, 1, 'The uploaded file is invalid'),
  ('m_C', 0, 1, 'Uploaded file contains more than one file'),
  ('m_D', 1, 1, 'Map loaded (1)'),
  ('m_E', 1, 1, 'Map loaded (2)'),
  ('m_F', 1, 1, 'Map loaded (3)'),
  ('g_A', 0, 1, 'Final report file with missing column errors'),
  ('g_B', 0, 1, 'Final report file not found or incorrectly named'),
  ('g_C', 0, 1, 'Final Report file with errors (1)'),
  ('g_D', 1, 1, 'Genotype processing completed'),
  ('g_E', 0, 1, 'Final Report file with errors (2)'),
  ('g_F', 0, 1, 'Final report map not found or does not match'),
  ('g_G', 0, 1, 'Final Report file with errors (2)'),
  ('g_H', 0, 1, 'Uploaded file contains more than one file'),
  ('g_I', 1, 1, 'Genotypes ready for loading'),
  ('g_K', 1, 1, 'Genotypes ready for loading'),
  ('g_L', 0, 1, 'Sample number does not correspond'),
  ('g_M', 0, 1, 'Chip exists but separator different from those in the parameter list'),
  ('g_N', 0, 1, 'Number or Names of SNPs different from an already loaded map. Correct or load new map')"""


def _outcome_values() -> str:
    return f"outc AS (SELECT * FROM (VALUES {_OUTCOME_ROWS}) t(code, bit_ok, bit_elaborato, errori_elab))"


_MAP_OUTCOMES = _MAPS + "," + _naming("mrec") + "," + _outcome_values() + """,
mout AS (SELECT m.upload_id,
                CASE WHEN m.i_name IS NULL OR coalesce(c.n_null, 0) > 0 OR c.n_rows IS NULL THEN 'm_B'
                     WHEN c.verdict = 'm_A' THEN 'm_A' ELSE n.code END AS code,
                CASE WHEN m.i_name IS NOT NULL AND c.verdict = 'ok' THEN n.map_name END AS map_name,
                CAST(c.n_rows AS INTEGER) AS n_snp
         FROM mlay m LEFT JOIN chk c USING (upload_id) LEFT JOIN named n USING (upload_id))"""

oracle("q12", ["fx_map_lines", "fx_map_catalog", "fx_map_snps"], """
SELECT upload_id, code, map_name, n_snp, bit_ok, bit_elaborato, errori_elab FROM mout LEFT JOIN outc USING (code)""",
       _MAP_OUTCOMES)

# --------------------------------------------------------------------------
# report checks and resolution
# --------------------------------------------------------------------------

_COUNTS = """
rps AS (SELECT nume_cari, sample_id, count(*) AS n_rows FROM rcalls GROUP BY 1, 2),
rcount AS (SELECT nume_cari, count(*) AS n_samples, sum(n_rows) AS n_rows, min(n_rows) AS min_rows,
                  max(n_rows) AS max_rows, min(n_rows) = max(n_rows) AS is_uniform,
                  CASE WHEN count(*) > 0 THEN CAST(sum(n_rows) AS BIGINT) // count(*) END AS chip_size
           FROM rps GROUP BY 1),
rsnp AS (SELECT nume_cari, count(DISTINCT snp_name) AS n_report_snps FROM rcalls GROUP BY 1),
by_alias AS (SELECT map_alias AS chip, max(map_name) AS alias_map FROM fx_map_catalog GROUP BY 1),
by_count AS (SELECT number_snp, max(map_name) AS count_map FROM fx_map_catalog GROUP BY 1),
res AS (SELECT p.nume_cari, p.chip,
               CASE WHEN p.chip IS NOT NULL THEN coalesce(a.alias_map, b.count_map) ELSE b.count_map END AS map_name,
               CASE WHEN p.chip IS NOT NULL AND a.alias_map IS NOT NULL THEN 'alias'
                    WHEN b.count_map IS NOT NULL THEN 'count' END AS resolved_by,
               p.chip IS NOT NULL AND a.alias_map IS NULL AND b.count_map IS NOT NULL AS alias_update,
               x.lookup_size
        FROM rpos p
        JOIN (SELECT p.nume_cari, CAST(CASE WHEN p.chip IS NOT NULL THEN s.n_report_snps ELSE c.chip_size END AS INTEGER) AS lookup_size
              FROM rpos p LEFT JOIN rcount c USING (nume_cari) LEFT JOIN rsnp s USING (nume_cari)) x USING (nume_cari)
        LEFT JOIN by_alias a ON a.chip = p.chip LEFT JOIN by_count b ON b.number_snp = x.lookup_size)"""

oracle("q16", ["fx_raw_lines"], "SELECT nume_cari, sample_id, n_rows FROM rps", _REPORT + "," + _COUNTS)
oracle("q17", ["fx_raw_lines"], "SELECT nume_cari, n_samples, min_rows, max_rows, is_uniform FROM rcount",
       _REPORT + "," + _COUNTS)
oracle("q18", ["fx_raw_lines"], "SELECT nume_cari, CAST(n_rows AS BIGINT) AS n_rows, n_samples, chip_size FROM rcount",
       _REPORT + "," + _COUNTS)
oracle("q19", ["fx_raw_lines", "fx_map_catalog"], """
SELECT p.nume_cari, p.chip, a.alias_map AS map_name FROM rpos p LEFT JOIN by_alias a ON a.chip = p.chip
WHERE p.chip IS NOT NULL""", _REPORT + "," + _COUNTS)
oracle("q20", ["fx_raw_lines", "fx_map_catalog"], """
SELECT c.nume_cari, CAST(c.chip_size AS INTEGER) AS chip_size, b.count_map AS map_name
FROM rcount c LEFT JOIN by_count b ON b.number_snp = c.chip_size""", _REPORT + "," + _COUNTS)
oracle("q21", ["fx_raw_lines", "fx_map_catalog"], "SELECT * FROM res", _REPORT + "," + _COUNTS)

_CATALOGUE_SNPS = """
csnp AS (SELECT c.map_name, s.snp_name FROM fx_map_catalog c JOIN fx_map_snps s USING (map_alias)
         UNION ALL SELECT map_name, snp_name FROM fx_snp_map)"""

oracle("q22", ["fx_calls", "fx_snp_map", "fx_raw_lines", "fx_map_catalog", "fx_map_snps"], """
SELECT r.nume_cari, 'MAIN_a' AS map_name, r.n AS n_report_snps, m.n AS n_map_snps, r.k AS n_matched,
       x.n_outer, x.n_outer = r.n AND x.n_outer = m.n AS consistent
FROM (SELECT d.nume_cari, count(*) AS n, count(s.snp_name) AS k
      FROM (SELECT DISTINCT nume_cari, snp_name FROM fx_calls) d
      LEFT JOIN (SELECT DISTINCT snp_name FROM fx_snp_map WHERE map_name = 'MAIN_a') s USING (snp_name) GROUP BY 1) r
CROSS JOIN (SELECT count(DISTINCT snp_name) AS n FROM fx_snp_map WHERE map_name = 'MAIN_a') m
JOIN (SELECT u.nume_cari, count(*) AS n_outer
      FROM (SELECT DISTINCT nume_cari FROM fx_calls) u,
           LATERAL (SELECT * FROM (SELECT DISTINCT snp_name FROM fx_calls c WHERE c.nume_cari = u.nume_cari) a
                    FULL OUTER JOIN (SELECT DISTINCT snp_name FROM fx_snp_map WHERE map_name = 'MAIN_a') b
                    USING (snp_name)) j
      GROUP BY 1) x USING (nume_cari)
UNION ALL
SELECT r.nume_cari, r.map_name, a.n, m.n, k.n, o.n, o.n = a.n AND o.n = m.n
FROM res r, LATERAL (SELECT count(DISTINCT snp_name) AS n FROM rcalls c WHERE c.nume_cari = r.nume_cari) a,
     LATERAL (SELECT count(DISTINCT snp_name) AS n FROM csnp c WHERE c.map_name = r.map_name) m,
     LATERAL (SELECT count(*) AS n FROM (SELECT snp_name FROM rcalls c WHERE c.nume_cari = r.nume_cari
                                         INTERSECT SELECT snp_name FROM csnp c WHERE c.map_name = r.map_name)) k,
     LATERAL (SELECT count(*) AS n FROM (SELECT snp_name FROM rcalls c WHERE c.nume_cari = r.nume_cari
                                         UNION SELECT snp_name FROM csnp c WHERE c.map_name = r.map_name)) o
WHERE r.map_name IS NOT NULL""", _REPORT + "," + _COUNTS + "," + _CATALOGUE_SNPS)

# --------------------------------------------------------------------------
# reconciliation and status
# --------------------------------------------------------------------------

_ARCHIVE = f"""
arch AS (SELECT DISTINCT trim(chr_codicecampionelab, ' ' || chr(9) || chr(13) || chr(10)) AS sample_id
         FROM fx_archive WHERE chr_codicecampionelab IS NOT NULL)"""

oracle("q33", ["fx_calls", "fx_archive"], """
SELECT DISTINCT nume_cari, sample_id FROM fx_calls WHERE sample_id NOT IN (SELECT sample_id FROM arch)""", _ARCHIVE)
oracle("q34", ["fx_staging"], "SELECT nume_cari, replace(campione, ' ', '') AS campione FROM fx_staging")
oracle("q35", ["fx_raw_lines"], """
SELECT DISTINCT nume_cari, sample_id, CAST(length(sample_id) AS INTEGER) AS id_length
FROM rcalls WHERE length(sample_id) > 25""", _REPORT)


def _summary(calls: str, staging: str) -> str:
    return _ARCHIVE + f""",
smp AS (SELECT DISTINCT nume_cari, sample_id FROM {calls}),
nmiss AS (SELECT * FROM smp WHERE sample_id NOT IN (SELECT sample_id FROM arch)),
stg AS (SELECT s.nume_cari, replace(s.campione, ' ', '') AS campione FROM {staging} s
        WHERE s.nume_cari IN (SELECT nume_cari FROM smp)),
f_miss AS (SELECT nume_cari, string_agg(sample_id, ', ' ORDER BY sample_id) AS l FROM
           (SELECT *, row_number() OVER (PARTITION BY nume_cari ORDER BY sample_id) AS rn FROM nmiss) t
           WHERE rn <= 10 GROUP BY 1),
f_stg AS (SELECT nume_cari, string_agg(campione, ', ' ORDER BY campione) AS l FROM
          (SELECT *, row_number() OVER (PARTITION BY nume_cari ORDER BY campione) AS rn
           FROM (SELECT DISTINCT * FROM stg) d) t WHERE rn <= 10 GROUP BY 1),
summ AS (SELECT s.nume_cari, s.n AS n_samples, coalesce(m.n, 0) AS n_not_in_archive,
                coalesce(fm.l, '') AS first_not_in_archive, coalesce(g.n, 0) AS n_staged, coalesce(fg.l, '') AS first_staged
         FROM (SELECT nume_cari, count(*) AS n FROM smp GROUP BY 1) s
         LEFT JOIN (SELECT nume_cari, count(*) AS n FROM nmiss GROUP BY 1) m USING (nume_cari)
         LEFT JOIN (SELECT nume_cari, count(*) AS n FROM stg GROUP BY 1) g USING (nume_cari)
         LEFT JOIN f_miss fm USING (nume_cari) LEFT JOIN f_stg fg USING (nume_cari)),
summt AS (SELECT *, replace(
            CAST(n_samples AS VARCHAR) || ' genotypes ready to be uploaded.' || chr(10)
            || CASE WHEN n_not_in_archive > 0 THEN CAST(n_not_in_archive AS VARCHAR) || ' samples not present in genomic archive' || chr(10)
                    || 'The first 10 are: ' || first_not_in_archive || chr(10) ELSE '' END
            || CASE WHEN n_staged > 0 THEN CAST(n_staged AS VARCHAR) || ' samples with existing Genotype that will be overwritten,' || chr(10)
                    || 'The first 10 are: ' || first_staged || ' '
                    ELSE CAST(n_staged AS VARCHAR) || ' samples with existing Genotype that will be overwritten.' END,
            '''', '"') AS summary FROM summ)"""


oracle("q36", ["fx_raw_lines", "fx_archive", "fx_staging"], "SELECT * FROM summt",
       _REPORT + "," + _summary("rcalls", "fx_staging"))

_GENO_TAIL = _CATALOGUE_SNPS + """,
cons AS (SELECT r.nume_cari,
                count(DISTINCT d.snp_name) = count(DISTINCT m.snp_name)
                AND count(DISTINCT d.snp_name) = (SELECT count(DISTINCT snp_name) FROM csnp WHERE map_name = r.map_name)
                AND count(DISTINCT d.snp_name) = (SELECT count(DISTINCT snp_name) FROM rcalls c WHERE c.nume_cari = r.nume_cari)
                AS consistent
         FROM res r JOIN (SELECT DISTINCT nume_cari, snp_name FROM rcalls) d USING (nume_cari)
         LEFT JOIN csnp m ON m.map_name = r.map_name AND m.snp_name = d.snp_name
         WHERE r.map_name IS NOT NULL GROUP BY r.nume_cari, r.map_name),
short AS (SELECT nume_cari, sum(CASE WHEN sample_id IS NULL OR snp_name IS NULL OR a1 IS NULL OR a2 IS NULL THEN 1 ELSE 0 END) AS n_short
          FROM rcalls GROUP BY 1),
gout AS (SELECT p.nume_cari,
                CASE WHEN NOT coalesce(starts_with(p.first_line, '[Header]'), false) THEN 'c_A'
                     WHEN p.sep IS NULL THEN 'g_M'
                     WHEN p.i_a1 IS NULL OR p.i_a2 IS NULL THEN 'g_A'
                     WHEN coalesce(s.n_short, 0) > 0 THEN 'g_E'
                     WHEN coalesce(c.n_samples, 0) = 0 THEN 'g_C'
                     WHEN NOT c.is_uniform THEN 'g_C'
                     WHEN r.map_name IS NULL OR NOT coalesce(k.consistent, false) THEN 'g_N'
                     WHEN r.alias_update THEN 'g_K' ELSE 'g_I' END AS code,
                r.map_name
         FROM rpos p LEFT JOIN short s USING (nume_cari) LEFT JOIN rcount c USING (nume_cari)
         LEFT JOIN res r USING (nume_cari) LEFT JOIN cons k USING (nume_cari))"""
_GENO = _REPORT + "," + _COUNTS + "," + _outcome_values() + "," + _GENO_TAIL

oracle("q37", ["fx_raw_lines", "fx_map_catalog", "fx_map_snps", "fx_snp_map"], """
SELECT nume_cari, code, map_name, bit_ok, bit_elaborato, errori_elab FROM gout LEFT JOIN outc USING (code)""", _GENO)

_MOUT = """
mout AS (SELECT m.upload_id,
                CASE WHEN m.i_name IS NULL OR coalesce(c.n_null, 0) > 0 OR c.n_rows IS NULL THEN 'm_B'
                     WHEN c.verdict = 'm_A' THEN 'm_A' ELSE n.code END AS code
         FROM mlay m LEFT JOIN chk c USING (upload_id) LEFT JOIN named n USING (upload_id))"""

oracle("q38", ["fx_raw_lines", "fx_map_catalog", "fx_map_snps", "fx_snp_map", "fx_jobs", "fx_map_lines",
               "fx_archive"], f"""
SELECT CAST(nume_cari AS VARCHAR) AS nume_cari, o.code, bit_ok, bit_elaborato, errori_elab
FROM (SELECT nume_cari, {_TYPE_CODE} AS code FROM fx_jobs WHERE {_PENDING}) o JOIN outc USING (code)
UNION ALL
SELECT CAST(g.nume_cari AS VARCHAR), g.code, o.bit_ok, o.bit_elaborato,
       CASE WHEN o.bit_ok = 1 THEN t.summary ELSE o.errori_elab END
FROM gout g LEFT JOIN outc o USING (code) LEFT JOIN summt t USING (nume_cari)
UNION ALL
SELECT upload_id, m.code, o.bit_ok, o.bit_elaborato, o.errori_elab FROM mout m LEFT JOIN outc o USING (code)""",
       ",".join([_GENO, _MAPS_BODY, _naming("mrec"), _MOUT, """
encoded AS (SELECT DISTINCT nume_cari, sample_id AS campione FROM rcalls
            WHERE nume_cari IN (SELECT nume_cari FROM gout WHERE code IN ('g_I', 'g_K')))""",
                 _summary("rcalls", "encoded")]))


# --------------------------------------------------------------------------
# population-genetics extensions (brute force per position)
# --------------------------------------------------------------------------

_FREQ = _positions("MAIN_a") + "," + _last() + """,
nsmp AS (SELECT count(DISTINCT sample_id) AS n_samples FROM lc),
cnt AS (SELECT pos, count(*) FILTER (WHERE code = 0) AS n0, count(*) FILTER (WHERE code = 1) AS n1,
               count(*) FILTER (WHERE code = 2) AS n2 FROM lc WHERE code IN (0, 1, 2) GROUP BY 1),
fr0 AS (SELECT mp.pos, mp.snp_key AS snp_name, coalesce(n0, 0) AS n0, coalesce(n1, 0) AS n1, coalesce(n2, 0) AS n2,
               coalesce(n0, 0) + coalesce(n1, 0) + coalesce(n2, 0) AS n_called, n_samples
        FROM mp LEFT JOIN cnt USING (pos) CROSS JOIN nsmp),
fr AS (SELECT *, CASE WHEN n_called > 0 THEN (2 * n2 + n1) / (2 * n_called) END AS p FROM fr0)"""

oracle("x01", ["fx_calls", "fx_snp_map"], """
SELECT 'MAIN_a' AS map_name, pos, snp_name, n0, n1, n2, n_called, round(p, 6) AS p_a,
       round(least(p, 1 - p), 6) AS maf,
       coalesce(least(p, 1 - p) >= 0.05, false) AND n_called / n_samples >= 0.9 AS informative
FROM fr""", _FREQ)

oracle("x02", ["fx_calls", "fx_snp_map"], """
SELECT 'MAIN_a' AS map_name, pos, snp_name, n_called, n_samples, round_even(n_called / n_samples, 4) AS call_rate
FROM fr""", _FREQ)

_PAIRS = """
gt AS (SELECT DISTINCT sample_id FROM lc),
cc AS (SELECT sample_id, pos, code FROM lc WHERE code IN (0, 1, 2)),
ped AS (SELECT child, sire AS parent, 'sire' AS role FROM fx_pedigree
        UNION ALL SELECT child, dam, 'dam' FROM fx_pedigree)"""

oracle("x03", ["fx_calls", "fx_snp_map", "fx_pedigree"], """
SELECT p.child, p.parent, p.role, coalesce(n_compared, 0) AS n_compared, coalesce(n_opposing, 0) AS n_opposing
FROM (SELECT * FROM ped WHERE child IN (SELECT sample_id FROM gt) AND parent IN (SELECT sample_id FROM gt)) p
LEFT JOIN (SELECT p.child, p.parent, p.role, count(*) AS n_compared,
                  count(*) FILTER (WHERE (c.code = 0 AND g.code = 2) OR (c.code = 2 AND g.code = 0)) AS n_opposing
           FROM ped p JOIN cc c ON c.sample_id = p.child JOIN cc g ON g.sample_id = p.parent AND g.pos = c.pos
           GROUP BY 1, 2, 3) x USING (child, parent, role)""", _positions("MAIN_a") + "," + _last() + "," + _PAIRS)


def _verdict_sql(opp: str, cmp: str) -> str:
    return f"CASE WHEN {cmp} = 0 THEN 'untested' WHEN {opp} / {cmp} <= 0.01 THEN 'compatible' ELSE 'excluded' END"


oracle("x04", ["fx_calls", "fx_snp_map", "fx_pedigree"], f"""
SELECT child, sire, dam, sire_compared, sire_opposing, {_verdict_sql("sire_opposing", "sire_compared")} AS sire_verdict,
       dam_compared, dam_opposing, {_verdict_sql("dam_opposing", "dam_compared")} AS dam_verdict,
       trio_compared, trio_conflicts
FROM (SELECT t.child, t.sire, t.dam,
             coalesce(count(s), 0) AS sire_compared,
             count(*) FILTER (WHERE (c = 0 AND s = 2) OR (c = 2 AND s = 0)) AS sire_opposing,
             coalesce(count(d), 0) AS dam_compared,
             count(*) FILTER (WHERE (c = 0 AND d = 2) OR (c = 2 AND d = 0)) AS dam_opposing,
             count(*) FILTER (WHERE s IS NOT NULL AND d IS NOT NULL) AS trio_compared,
             count(*) FILTER (WHERE s IS NOT NULL AND d IS NOT NULL AND
                              ((c = 2 AND (s = 0 OR d = 0)) OR (c = 0 AND (s = 2 OR d = 2))
                               OR (c = 1 AND ((s = 0 AND d = 0) OR (s = 2 AND d = 2))))) AS trio_conflicts
      FROM (SELECT child, sire, dam FROM fx_pedigree
            WHERE child IN (SELECT sample_id FROM gt) AND sire IN (SELECT sample_id FROM gt)
              AND dam IN (SELECT sample_id FROM gt)) t
      LEFT JOIN (SELECT x.child, x.sire, x.dam, c.code AS c, s.code AS s, d.code AS d
                 FROM fx_pedigree x JOIN cc c ON c.sample_id = x.child
                 LEFT JOIN cc s ON s.sample_id = x.sire AND s.pos = c.pos
                 LEFT JOIN cc d ON d.sample_id = x.dam AND d.pos = c.pos) j
        ON j.child = t.child AND j.sire = t.sire AND j.dam = t.dam
      GROUP BY 1, 2, 3) a""", _positions("MAIN_a") + "," + _last() + "," + _PAIRS)

oracle("x05", ["fx_calls", "fx_snp_map"], """
SELECT 'MAIN_a' AS map_name, count(*) AS n_snps,
       round(1 - exp(sum(ln(1 - 2 * p * p * (1 - p) * (1 - p)))), 6) AS pe_combined,
       round(avg(2 * p * p * (1 - p) * (1 - p)), 6) AS pe_mean
FROM fr WHERE p > 0 AND p < 1""", _FREQ)

oracle("x06", ["fx_calls", "fx_snp_map", "fx_pedigree"], """
SELECT child, parent, role, count(*) AS n_snps, round(sum(ln(((1 - 0.01) * t + 0.01 * pr) / pr)), 4) AS lod
FROM (SELECT p.child, p.parent, p.role, f.p,
             CASE WHEN c.code = 2 THEN f.p * f.p WHEN c.code = 1 THEN 2 * f.p * (1 - f.p) ELSE (1 - f.p) * (1 - f.p) END AS pr,
             CASE WHEN g.code = 2 THEN CASE WHEN c.code = 2 THEN f.p WHEN c.code = 1 THEN 1 - f.p ELSE 0.0 END
                  WHEN g.code = 1 THEN CASE WHEN c.code = 2 THEN f.p / 2 WHEN c.code = 1 THEN 0.5 ELSE (1 - f.p) / 2 END
                  ELSE CASE WHEN c.code = 2 THEN 0.0 WHEN c.code = 1 THEN f.p ELSE 1 - f.p END END AS t
      FROM ped p JOIN cc c ON c.sample_id = p.child JOIN cc g ON g.sample_id = p.parent AND g.pos = c.pos
      JOIN fr f ON f.pos = c.pos WHERE f.p > 0 AND f.p < 1) x
GROUP BY 1, 2, 3""", _FREQ + "," + _PAIRS)

oracle("x07", ["fx_pedigree"], """
SELECT sample, ancestor, min(gen) AS generation FROM anc GROUP BY 1, 2""", """
edges AS (SELECT DISTINCT child, parent FROM (SELECT child, sire AS parent FROM fx_pedigree
                                              UNION ALL SELECT child, dam FROM fx_pedigree) e WHERE parent IS NOT NULL),
anc(sample, ancestor, gen) AS (
  SELECT child, parent, 1 FROM edges
  UNION
  SELECT a.sample, e.parent, a.gen + 1 FROM anc a JOIN edges e ON e.child = a.ancestor)""", recursive=True)

oracle("x08", ["fx_pedigree"], """
SELECT p.child, p.sire, p.dam,
       count(*) FILTER (WHERE q.sire = p.sire AND q.dam = p.dam) AS n_full_sibs,
       count(*) FILTER (WHERE q.sire = p.sire AND (q.dam = p.dam) IS NOT TRUE) AS n_paternal_half_sibs,
       count(*) FILTER (WHERE q.sire = p.sire AND (q.dam IS NULL OR p.dam IS NULL)) AS n_paternal_unresolved,
       count(*) FILTER (WHERE q.dam = p.dam AND (q.sire = p.sire) IS NOT TRUE) AS n_maternal_half_sibs,
       count(*) FILTER (WHERE q.dam = p.dam AND (q.sire IS NULL OR p.sire IS NULL)) AS n_maternal_unresolved
FROM fx_pedigree p LEFT JOIN fx_pedigree q ON q.child <> p.child GROUP BY p.child, p.sire, p.dam""")

oracle("x09", ["fx_calls", "fx_snp_map"], """
SELECT 'MAIN_a' AS map_name, a.pos, mp.snp_key AS snp_name, a.n_groups, round(a.hs, 6) AS hs,
       round(2 * pbar * (1 - pbar), 6) AS ht,
       round(CASE WHEN 2 * pbar * (1 - pbar) > 0 THEN (2 * pbar * (1 - pbar) - hs) / (2 * pbar * (1 - pbar)) END, 6) AS fst
FROM (SELECT pos, count(*) AS n_groups, avg(2 * p * (1 - p)) AS hs, avg(p) AS pbar
      FROM (SELECT pos, nume_cari, (2 * count(*) FILTER (WHERE code = 2) + count(*) FILTER (WHERE code = 1)) / (2 * count(*)) AS p
            FROM lc WHERE code IN (0, 1, 2) GROUP BY 1, 2) g GROUP BY 1) a
JOIN mp USING (pos)""", _positions("MAIN_a") + "," + _last())


# --------------------------------------------------------------------------
# parent search, assignment and error rates on the derived families
# --------------------------------------------------------------------------

_FAMILY = ["fx_family_calls", "fx_family_pedigree"]
_SEARCH = """
cc AS (SELECT sample_id, pos, code FROM fx_family_calls WHERE code IN (0, 1, 2)),
pairs AS (SELECT c.sample_id AS child, g.sample_id AS candidate, count(*) AS n_compared,
                 count(*) FILTER (WHERE (c.code = 0 AND g.code = 2) OR (c.code = 2 AND g.code = 0)) AS n_opposing
          FROM cc c JOIN cc g ON g.pos = c.pos WHERE c.sample_id IN (SELECT child FROM fx_family_pedigree) GROUP BY 1, 2),
rec AS (SELECT DISTINCT child, sire AS parent FROM fx_family_pedigree UNION SELECT child, dam FROM fx_family_pedigree),
gone AS (SELECT pairs.child, candidate FROM pairs JOIN rec ON rec.child = pairs.child AND parent = candidate
         WHERE n_opposing / n_compared > CAST(0.03 AS DOUBLE)),
kids AS (SELECT p.child, sire, dam, s.candidate IS NOT NULL AS sire_out, d.candidate IS NOT NULL AS dam_out
         FROM fx_family_pedigree p LEFT JOIN gone s ON s.child = p.child AND s.candidate = sire
         LEFT JOIN gone d ON d.child = p.child AND d.candidate = dam WHERE p.child IN (SELECT sample_id FROM cc)),
roles AS (SELECT child, 'sire' AS role, CASE WHEN sire_out THEN 'excluded' ELSE 'unknown' END AS reason, sire AS recorded,
                 CASE WHEN NOT dam_out THEN dam END AS other FROM kids WHERE sire IS NULL OR sire_out
          UNION ALL
          SELECT child, 'dam', CASE WHEN dam_out THEN 'excluded' ELSE 'unknown' END, dam, CASE WHEN NOT sire_out THEN sire END
          FROM kids WHERE dam IS NULL OR dam_out),
found AS (SELECT * FROM (
  SELECT roles.child, role, reason, recorded, row_number() OVER (PARTITION BY roles.child, role
           ORDER BY n_opposing / n_compared, n_compared DESC, candidate) AS rank, candidate, n_compared, n_opposing
  FROM roles JOIN pairs ON pairs.child = roles.child
  WHERE candidate <> roles.child AND (other IS NULL OR other <> candidate) AND n_compared >= 20
    AND n_opposing <= CAST(0.03 AS DOUBLE) * n_compared
    AND NOT EXISTS (SELECT 1 FROM rec WHERE rec.child = candidate AND rec.parent = roles.child)) WHERE rank <= 3)"""

oracle("x10", _FAMILY, "SELECT * FROM found", _SEARCH)

_FAMILY_P = """
fp AS (SELECT pos, sum(code) / (2 * count(*)) AS p FROM fx_family_calls WHERE code IN (0, 1, 2) GROUP BY 1)"""


def _mendel(c: str, s: str, d: str) -> str:
    """Chance of the child's genotype for its parents' genotypes."""
    return (f"CASE {c} WHEN 0 THEN (1 - {s} / 2) * (1 - {d} / 2) WHEN 2 THEN {s} / 2 * {d} / 2 "
            f"ELSE {s} / 2 * (1 - {d} / 2) + (1 - {s} / 2) * {d} / 2 END")


def _prior(c: str) -> str:
    return f"CASE {c} WHEN 0 THEN (1 - p) * (1 - p) WHEN 1 THEN 2 * p * (1 - p) ELSE p * p END"


oracle("x11", _FAMILY, """
SELECT a.child, a.one AS parent_1, a.two AS parent_2, a.n_snps, round(a.s, 4) AS lod, b.one AS next_1, b.two AS next_2,
       round(b.s, 4) AS next_lod, round(a.s - b.s, 4) AS delta, a.n_pairs
FROM ranked a LEFT JOIN ranked b ON b.child = a.child AND b.r = 2 WHERE a.r = 1""", _SEARCH + "," + _FAMILY_P + f""",
may AS (SELECT child, candidate FROM found UNION
        SELECT rec.child, parent FROM rec JOIN pairs ON pairs.child = rec.child AND candidate = parent
        WHERE n_opposing <= CAST(0.03 AS DOUBLE) * n_compared),
scored AS (SELECT x.child, x.candidate AS one, y.candidate AS two, count(p) AS n_snps,
                  round(coalesce(sum(ln(((1 - 0.01) * t + 0.01 * pr) / pr)), 0), 6) AS s
           FROM may x JOIN may y ON y.child = x.child AND y.candidate > x.candidate
           LEFT JOIN LATERAL (SELECT p, {_mendel('c.code', 'g.code', 'h.code')} AS t, {_prior('c.code')} AS pr
                      FROM cc c JOIN cc g ON g.pos = c.pos JOIN cc h ON h.pos = c.pos JOIN fp ON fp.pos = c.pos
                      WHERE c.sample_id = x.child AND g.sample_id = x.candidate AND h.sample_id = y.candidate
                        AND p > 0 AND p < 1) ON true
           GROUP BY 1, 2, 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY child ORDER BY s DESC, one, two) AS r,
                  count(*) OVER (PARTITION BY child) AS n_pairs FROM scored)""")


def _em(rounds: int) -> str:
    """Expectation-maximisation of the rate of each SNP, one step a round."""
    steps = ["e0 AS (SELECT DISTINCT pos, CAST(0.05 AS DOUBLE) AS e FROM tri)"]
    steps += [f"e{k} AS (SELECT pos, sum(n * e * b / ((1 - e) * t + e * b)) / sum(n) AS e FROM tri JOIN e{k - 1} USING (pos) "
              "GROUP BY 1)" for k in range(1, rounds + 1)]
    steps += [f"l{k} AS (SELECT pos, sum(n) AS n, sum(n * ln((1 - e) * t + e * b)) AS l FROM tri JOIN e{k} USING (pos) GROUP BY 1)"
              for k in (0, rounds)]
    return ",\n".join(steps)


oracle("x12", _FAMILY, """
SELECT pos, CAST(l8.n AS BIGINT) AS n_trios, round(e, 8) AS rate, round(l0.l, 6) AS first_log_likelihood,
       round(l8.l, 6) AS log_likelihood, CAST(8 AS BIGINT) AS rounds
FROM l8 JOIN l0 USING (pos) JOIN e8 USING (pos)""", _FAMILY_P + f""",
cc AS (SELECT sample_id, pos, code FROM fx_family_calls WHERE code IN (0, 1, 2)),
tri AS (SELECT pos, count(*) AS n, {_mendel('c', 's', 'd')} AS t, {_prior('c')} AS b
        FROM (SELECT fp.pos, p, c.code AS c, s.code AS s, d.code AS d FROM fx_family_pedigree x
              JOIN cc c ON c.sample_id = x.child JOIN cc s ON s.sample_id = x.sire AND s.pos = c.pos
              JOIN cc d ON d.sample_id = x.dam AND d.pos = c.pos JOIN fp ON fp.pos = c.pos WHERE p > 0 AND p < 1)
        GROUP BY pos, p, c, s, d),
""" + _em(8))


# --------------------------------------------------------------------------
# pedigree on the derived lineage: closures, and coancestry by expanding the younger of a pair
# --------------------------------------------------------------------------

oracle("x14", ["fx_lineage"], """
SELECT s AS sample, 'own_ancestor' AS contradiction, min(len) AS n FROM walk WHERE s = place GROUP BY 1
UNION ALL SELECT parent, 'sire_and_dam', least(count(*) FILTER (WHERE role = 's'), count(*) FILTER (WHERE role = 'd'))
FROM roles GROUP BY 1 HAVING count(DISTINCT role) = 2
UNION ALL SELECT child, 'one_parent_twice', count(*) FROM rec WHERE sire = dam GROUP BY 1
UNION ALL SELECT child, 'several_records', count(*) FROM rec GROUP BY 1 HAVING count(*) > 1""", """
rec AS (SELECT DISTINCT child, sire, dam FROM fx_lineage),
roles AS (SELECT DISTINCT child, sire AS parent, 's' AS role FROM rec WHERE sire IS NOT NULL
          UNION SELECT child, dam, 'd' FROM rec WHERE dam IS NOT NULL),
e AS (SELECT DISTINCT child, parent FROM roles),
clo(sample, ancestor) AS (SELECT child, parent FROM e UNION SELECT c.sample, e.parent FROM clo c JOIN e ON e.child = c.ancestor),
cyc AS (SELECT sample FROM clo WHERE sample = ancestor),
walk(s, place, len) AS (
  SELECT child, parent, CAST(1 AS BIGINT) FROM e WHERE child IN (FROM cyc) AND parent IN (FROM cyc)
  UNION
  SELECT w.s, e.parent, w.len + 1 FROM walk w JOIN e ON e.child = w.place
  WHERE e.parent IN (FROM cyc) AND w.s <> w.place AND w.len < (SELECT count(*) FROM cyc))""", recursive=True)

def _lineage(wanted: str) -> str:
    """Coancestry of the ``wanted`` pairs."""
    return f"""
one AS (SELECT child, sire, dam FROM (SELECT *, row_number() OVER (PARTITION BY child ORDER BY sire NULLS FIRST, dam NULLS FIRST) AS r
                                      FROM fx_lineage) t WHERE r = 1),
e AS (SELECT DISTINCT child, parent FROM (SELECT child, sire AS parent FROM one UNION ALL SELECT child, dam FROM one) t
      WHERE parent IS NOT NULL),
clo(sample, ancestor) AS (SELECT child, parent FROM e UNION SELECT c.sample, e.parent FROM clo c JOIN e ON e.child = c.ancestor),
cyc AS (SELECT sample FROM clo WHERE sample = ancestor),
good AS (SELECT DISTINCT sample FROM (SELECT child AS sample FROM fx_lineage UNION ALL SELECT sire FROM fx_lineage
                                      UNION ALL SELECT dam FROM fx_lineage) t
         WHERE sample IS NOT NULL AND sample NOT IN (FROM cyc)
           AND sample NOT IN (SELECT sample FROM clo WHERE ancestor IN (FROM cyc))),
steps(sample, g) AS (SELECT sample, 0 FROM good WHERE sample NOT IN (SELECT child FROM e)
                     UNION SELECT e.child, s.g + 1 FROM steps s JOIN e ON e.parent = s.sample WHERE e.child IN (FROM good)),
gen AS (SELECT sample, max(g) AS g FROM steps GROUP BY 1),
gp AS (SELECT one.* FROM one WHERE child IN (FROM good)),
wanted AS (SELECT DISTINCT o1, o2 FROM ({wanted}) t WHERE o1 IN (FROM good) AND o2 IN (FROM good)),
co(o1, o2, x, y, w) AS (
  SELECT o1, o2, o1, o2, CAST(1 AS DOUBLE) FROM wanted
  UNION ALL
  SELECT o1, o2, CASE WHEN x = y THEN sire ELSE t END, CASE WHEN x = y OR r = 2 THEN dam ELSE sire END, w / 2
  FROM (SELECT o1, o2, x, y, w, CASE WHEN (a.g, x) >= (b.g, y) THEN x ELSE y END AS z, CASE WHEN (a.g, x) >= (b.g, y) THEN y ELSE x END AS t
        FROM co JOIN gen a ON a.sample = x JOIN gen b ON b.sample = y) c
  JOIN gp ON gp.child = z JOIN (VALUES (1), (2)) v(r) ON x <> y OR r = 1
  WHERE CASE WHEN x = y THEN sire IS NOT NULL AND dam IS NOT NULL WHEN r = 1 THEN sire IS NOT NULL ELSE dam IS NOT NULL END),
found AS (SELECT o1, o2, sum(CASE WHEN x = y THEN w / 2 ELSE 0 END) AS phi FROM co GROUP BY 1, 2)"""


oracle("x15", ["fx_lineage"], """
SELECT gen.sample, gen.g AS generation, round(coalesce(phi, 0), 10) AS inbreeding
FROM gen LEFT JOIN gp ON gp.child = gen.sample LEFT JOIN found ON o1 = sire AND o2 = dam""", _lineage("SELECT sire AS o1, dam AS o2 FROM gp"), recursive=True)

oracle("x16", ["fx_lineage"], """
SELECT o1 AS sample_1, o2 AS sample_2, round(2 * phi, 10) AS relationship FROM found""", _lineage(
    "SELECT child AS o1, sire AS o2 FROM fx_lineage UNION ALL SELECT child, dam FROM fx_lineage "
    "UNION ALL SELECT sire, dam FROM fx_lineage"), recursive=True)

# the chance of each possible number of heterozygotes from factorials
oracle("x17", ["fx_calls", "fx_snp_map"], """
SELECT 'MAIN_a' AS map_name, fr.pos, snp_name, n0, n1, n2, round(p_value, 9) AS p_value,
       round(CASE WHEN n0 + n1 > 0 AND n2 + n1 > 0 THEN 1 - n1 / (2 * p * (1 - p) * n_called) END, 6) AS f
FROM fr JOIN tested USING (pos)""", _FREQ + """,
possible AS (SELECT pos, n1, n0, n2, n_called, unnest(range((n1 % 2), 2 * least(n0, n2) + n1 + 1, 2)) AS h FROM fr WHERE n_called > 0),
chances AS (SELECT pos, h = n1 AS found, h * ln(2) - lgamma(h + 1) - lgamma((2 * n0 + n1 - h) / 2 + 1) - lgamma((2 * n2 + n1 - h) / 2 + 1) AS l
            FROM possible),
relative AS (SELECT pos, l - max(l) OVER (PARTITION BY pos) AS l, max(CASE WHEN found THEN l END) OVER (PARTITION BY pos)
                    - max(l) OVER (PARTITION BY pos) AS l_found FROM chances),
tested AS (SELECT pos, least(1, sum(CASE WHEN l <= l_found + 1e-8 THEN exp(l) ELSE 0 END) / sum(exp(l))) AS p_value
           FROM relative GROUP BY 1)""")

# --------------------------------------------------------------------------
# substructure and panel choice on the derived populations
# --------------------------------------------------------------------------

_OWN_P = """
cc AS (SELECT sample_id, pos, code FROM fx_population_calls WHERE code IN (0, 1, 2)),
gp AS (SELECT pos, grp, sum(share * code) / (2 * sum(share)) AS p FROM cc JOIN fx_ancestry USING (sample_id) GROUP BY 1, 2),
own AS (SELECT sample_id, pos, sum(share * p) / sum(share) AS p FROM fx_ancestry JOIN gp USING (grp) GROUP BY 1, 2
        HAVING count(*) = (SELECT count(*) FROM fx_ancestry f WHERE f.sample_id = fx_ancestry.sample_id))"""

oracle("x19", ["fx_population_calls", "fx_ancestry"], """
SELECT sample_id, count(*) AS n_snps, round(1 - exp(sum(ln(1 - 2 * p * p * (1 - p) * (1 - p)))), 6) AS pe_combined
FROM own WHERE p > 0 AND p < 1 AND sample_id IN (SELECT sample_id FROM cc) GROUP BY 1""", _OWN_P)

oracle("x20", ["fx_population_calls", "fx_ancestry", "fx_pedigree"], f"""
SELECT child, parent, role, count(*) AS n_snps, round(sum(ln(((1 - 0.01) * t + 0.01 * pr) / pr)), 4) AS lod
FROM (SELECT r.child, parent, role, {_prior("c.code")} AS pr,
             CASE c.code WHEN 0 THEN (1 - g.code / 2) * (1 - p) WHEN 1 THEN g.code / 2 * (1 - p) + (1 - g.code / 2) * p
                         ELSE g.code / 2 * p END AS t
      FROM (SELECT child, sire AS parent, 'sire' AS role FROM fx_pedigree UNION ALL SELECT child, dam, 'dam' FROM fx_pedigree) r
      JOIN cc c ON c.sample_id = child JOIN cc g ON g.sample_id = parent AND g.pos = c.pos
      JOIN own ON own.sample_id = child AND own.pos = c.pos WHERE p > 0 AND p < 1) x
GROUP BY 1, 2, 3""", _OWN_P)

# the rule one SNP after the other, with the list of kept ones
oracle("x21", ["fx_population_calls"], """
SELECT pos, round(maf, 6) AS maf, list_contains(kept, i.k) AS kept,
       CASE WHEN NOT list_contains(kept, i.k) THEN (SELECT min(o.pos) FROM inf o JOIN linked ON o.k = linked.a WHERE linked.b = i.k AND list_contains(kept, o.k)) END AS told_by
FROM inf i CROSS JOIN (SELECT kept FROM seq ORDER BY k DESC LIMIT 1)""", """
cc AS (SELECT sample_id, pos, code FROM fx_population_calls WHERE code IN (0, 1, 2)),
ns AS (SELECT count(DISTINCT sample_id) AS n FROM fx_population_calls),
fq AS (SELECT pos, least(sum(code) / (2 * count(*)), 1 - sum(code) / (2 * count(*))) AS maf, count(*) AS m FROM cc GROUP BY 1),
inf AS MATERIALIZED (SELECT pos, maf, row_number() OVER (ORDER BY pos) AS k FROM fq CROSS JOIN ns
        WHERE maf >= CAST(0.05 AS DOUBLE) AND m / n >= CAST(0.9 AS DOUBLE)),
ic AS (SELECT sample_id, k, code FROM cc JOIN inf USING (pos)),
sums AS (SELECT a.k AS a, b.k AS b, CAST(count(*) AS DOUBLE) AS n, CAST(sum(a.code) AS DOUBLE) AS sa, CAST(sum(b.code) AS DOUBLE) AS sb,
                CAST(sum(a.code * a.code) AS DOUBLE) AS saa, CAST(sum(b.code * b.code) AS DOUBLE) AS sbb, CAST(sum(a.code * b.code) AS DOUBLE) AS sab
         FROM ic a JOIN ic b ON b.sample_id = a.sample_id AND b.k > a.k AND b.k <= a.k + 20 GROUP BY 1, 2),
linked AS MATERIALIZED (SELECT a, b FROM sums WHERE n * saa > sa * sa AND n * sbb > sb * sb
           AND (n * sab - sa * sb) * (n * sab - sa * sb) > CAST(0.2 AS DOUBLE) * ((n * saa - sa * sa) * (n * sbb - sb * sb))),
before AS MATERIALIZED (SELECT k, coalesce(l, []) AS l FROM inf LEFT JOIN (SELECT b, list(a) AS l FROM linked GROUP BY 1) ON b = k),
seq(k, kept) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT before.k, CASE WHEN list_has_any(l, kept) THEN kept ELSE list_append(kept, before.k) END FROM seq JOIN before ON before.k = seq.k + 1)""",
       recursive=True)

# --------------------------------------------------------------------------
# streaming queue
# --------------------------------------------------------------------------

oracle("s01", ["fx_jobs"], f"""
SELECT CAST(nume_cari AS VARCHAR) AS nume_cari, code, bit_ok, bit_elaborato, errori_elab
FROM (SELECT nume_cari, coalesce({_TYPE_CODE}, CASE WHEN tipo_cari = 'M' THEN 'c_B' ELSE 'g_B' END) AS code
      FROM fx_jobs WHERE {_PENDING}) j JOIN outc USING (code)""", _outcome_values())

oracle("s02", ["fx_jobs"], f"""
SELECT nume_cari, tipo_cari, nome_file FROM fx_jobs
WHERE {_PENDING} AND tipo_cari = 'M' AND ({_TYPE_CODE}) IS NULL""")

oracle("s03", ["fx_jobs"], f"""
SELECT CAST(nume_cari AS VARCHAR) AS nume_cari, code, bit_ok, bit_elaborato, errori_elab
FROM (SELECT nume_cari, {_TYPE_CODE} AS code FROM fx_jobs WHERE {_PENDING}) j JOIN outc USING (code)""", _outcome_values())

ORACLE["s04"] = ORACLE["s01"]  # every pending upload once, whatever run its row came in
