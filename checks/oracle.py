"""The same results in SQL, for DuckDB."""

from __future__ import annotations

_PATTERN = r"(([a-z]*/[0-9]*/)profiles/)([A-Z]*([0-9]*)_([0-9]*)[A-Z]*.nc)"


def _centre(key: str) -> str:
    return (
        "list_extract(['aoml','bodc','coriolis','csio','incois'], "
        f"CAST(({key}) % 5 AS INTEGER) + 1)"
    )


_INDEX = f"""
index_text AS (
  SELECT o_orderkey AS ord,
    {_centre("o_custkey + CASE WHEN o_custkey % 50 = 0 THEN o_orderkey % 2 ELSE 0 END")}
      || '/' || CAST(1900000 + o_custkey AS VARCHAR)
      || CASE WHEN o_orderkey % 997 = 0 THEN '/misplaced/' ELSE '/profiles/' END || 'S'
      || CASE WHEN o_orderstatus = 'O' THEN 'R' ELSE 'D' END
      || CAST(1900000 + o_custkey AS VARCHAR) || '_'
      || lpad(CAST(o_orderkey % 300 + 1 AS VARCHAR), 3, '0')
      || CASE WHEN o_orderkey % 10 = 0 THEN 'D' ELSE '' END || '.nc' AS file,
    CASE WHEN o_orderkey % 613 = 0 OR o_orderkey % 307 = 0 THEN NULL
         ELSE o_orderdate END AS date,
    CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey * 7919 % 18001 / 100 - 90 END AS latitude,
    CASE WHEN o_orderkey % 89 <> 0 THEN o_orderkey * 104729 % 36001 / 100 - 180 END AS longitude,
    'PRES TEMP PSAL' || CASE WHEN o_orderkey % 2 = 0 THEN ' DOXY' ELSE '' END
      || CASE WHEN o_orderkey % 3 = 0 THEN ' BBP700' ELSE '' END
      || CASE WHEN o_orderkey % 5 = 0 THEN ' CHLA_FLUORESCENCE' ELSE '' END
      || CASE WHEN o_orderkey % 7 = 0 THEN ' CHLA' ELSE '' END AS parameters,
    CASE WHEN o_orderkey % 211 <> 0
         THEN o_orderdate + to_days(CAST(o_orderkey % 400 AS INTEGER)) END AS date_update
  FROM orders),
v_index AS (
  SELECT *,
    CAST(nullif(regexp_extract(file, '{_PATTERN}', 4), '') AS BIGINT) AS wmoid,
    nullif(regexp_extract(file, '{_PATTERN}', 2), '') AS filepath_main,
    nullif(regexp_extract(file, '{_PATTERN}', 1), '') AS filepath,
    nullif(regexp_extract(file, '{_PATTERN}', 3), '') AS filename,
    CAST(nullif(regexp_extract(file, '{_PATTERN}', 5), '') AS BIGINT) AS cycle
  FROM index_text)
"""

_FLOAT_FILE = (
    _centre("c_custkey")
    + " || '/' || CAST(1900000 + c_custkey AS VARCHAR) || '/'"
    + " || CAST(1900000 + c_custkey AS VARCHAR) || '_Sprof.nc'"
)

_FILES = f"""
v_all_files AS (
  SELECT c_custkey, '/mirror/dac/' || {_FLOAT_FILE} AS path,
    TIMESTAMP '1998-06-01' + to_days(CAST(c_custkey * 7 % 1500 AS INTEGER)) AS mtime,
    100000 + c_custkey * 37 % 9000 AS length
  FROM customer),
v_files AS (SELECT path, mtime, length FROM v_all_files WHERE c_custkey % 3 <> 0),
v_remote AS (
  SELECT 'https://example.org/dac/' || {_FLOAT_FILE} AS url,
    CASE WHEN c_custkey % 23 <> 0
         THEN TIMESTAMP '1999-01-01' + to_days(CAST(c_custkey * 11 % 1800 AS INTEGER))
    END AS remote_mtime,
    CASE WHEN c_custkey % 29 = 0 THEN 404 ELSE 200 END AS status
  FROM customer)
"""


def _candidates(index: str) -> str:
    return f"""
floats AS (
  SELECT filepath_main, min(wmoid) AS wmoid FROM {index}
  WHERE filepath_main IS NOT NULL GROUP BY filepath_main),
candidates AS (
  SELECT filepath_main, wmoid, CAST(wmoid AS VARCHAR) || '_Sprof.nc' AS filename,
    '/mirror/dac/' || filepath_main || CAST(wmoid AS VARCHAR) || '_Sprof.nc' AS local_path,
    'https://example.org/dac/' || filepath_main || CAST(wmoid AS VARCHAR) || '_Sprof.nc' AS url
  FROM floats)
"""


def _states(index: str) -> str:
    return f"""
updates AS (
  SELECT wmoid, max(date_update) AS last_update,
    count(*) FILTER (WHERE date_update IS NULL) AS undated
  FROM {index} GROUP BY wmoid),
states AS (
  SELECT c.*, f.mtime, CASE WHEN f.mtime IS NULL THEN 'missing'
    WHEN u.undated = 0 AND u.last_update < f.mtime THEN 'current' ELSE 'stale' END AS state
  FROM candidates c LEFT JOIN v_files f ON c.local_path = f.path
  LEFT JOIN updates u ON c.wmoid = u.wmoid)
"""


_BY_TIME = """CASE WHEN mtime IS NOT NULL AND remote_mtime IS NULL THEN 'error'
    WHEN mtime IS NOT NULL AND remote_mtime <= mtime THEN 'keep'
    WHEN coalesce(status, 404) = 404 THEN 'missing_remote' ELSE 'fetch' END"""

_STAGED = """
merged AS (
  SELECT l_orderkey, (l_linenumber - 1) % 7 AS lvl, sum(l_quantity) AS pres,
    max(l_extendedprice) AS temp
  FROM lineitem GROUP BY ALL),
grid AS (
  SELECT *, unnest(generate_series(0, 6 + o_custkey % 3)) AS lvl FROM orders),
levels AS (
  SELECT CAST(o_custkey AS VARCHAR) AS source_file, o_orderkey AS "N_PROF",
    CAST(g.lvl AS BIGINT) AS "N_LEVELS", 1900000 + o_custkey AS "PLATFORM_NUMBER",
    o_orderkey % 300 + 1 AS "CYCLE_NUMBER",
    CASE WHEN o_orderkey % 10 = 0 THEN 'D' ELSE 'A' END AS "DIRECTION",
    o_orderkey * 7919 % 18001 / 100 - 90 AS "LATITUDE",
    o_orderkey * 104729 % 36001 / 100 - 180 AS "LONGITUDE",
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS "JULD",
    CAST(CAST(pres AS FLOAT) AS DOUBLE) AS "PRES",
    CAST(CAST(temp / 1000 AS FLOAT) AS DOUBLE) AS "TEMP",
    CASE WHEN pres IS NOT NULL THEN CAST(g.lvl + 1 AS BIGINT) END AS "TEMP_QC"
  FROM grid g LEFT JOIN merged m ON m.l_orderkey = g.o_orderkey AND m.lvl = g.lvl)
"""

_LEVEL_COLUMNS = (
    'source_file, "N_PROF", "N_LEVELS", "PLATFORM_NUMBER", "DIRECTION", "LATITUDE", "JULD", '
    '"PRES", "TEMP", "TEMP_QC"'
)

# Known parameters that can occur in the view, of the thirty the schema has.
_PARAMETERS = """
entries AS (
  SELECT CAST(user_id AS VARCHAR) AS source_file, event_id // 512 AS n_prof, user_id, event_id,
    CASE event_type WHEN 'click' THEN 'TEMP' WHEN 'view' THEN 'PSAL' WHEN 'purchase' THEN 'DOXY'
      WHEN 'signup' THEN 'FOO' ELSE '' END AS name,
    CASE WHEN user_id % 10 = 0 THEN NULL WHEN event_id % 501 = 0 THEN 'RR'
      ELSE list_extract(['R', 'A', 'D'], CAST(event_id % 3 AS INTEGER) + 1) END AS mode,
    event_id % 701 = 0 AS differs, value, user_id % 10 <> 0 AS has_modes
  FROM events),
flags AS (
  SELECT source_file, bool_or(has_modes AND differs) AS bad_calibration,
    bool_or(has_modes AND name IN ('TEMP', 'PSAL', 'DOXY') AND mode = 'RR') AS bad_mode
  FROM entries GROUP BY source_file),
profile_modes AS (
  SELECT source_file, n_prof, name, arg_max(mode, event_id) AS mode
  FROM entries WHERE has_modes AND name IN ('TEMP', 'PSAL', 'DOXY') GROUP BY ALL)
"""

_OBSERVATIONS = """
v_obs AS (
  SELECT event_id, ts AS "JULD", value AS "PRES_ADJUSTED",
    user_id * 271 % 5001 / 100 + 30 AS "LATITUDE",
    user_id * 613 % 4001 / 100 - 85 AS "LONGITUDE",
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'NaN'::DOUBLE
      ELSE value / 100 END AS "CHLA_ADJUSTED",
    event_id % 9 + 1 AS "CHLA_ADJUSTED_QC"
  FROM events)
"""

_BOX = '"LATITUDE" > 34 AND "LATITUDE" < 80 AND "LONGITUDE" > -78 AND "LONGITUDE" < -50'
_TIME_DEPTH = (
    "\"JULD\" BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' "
    'AND "PRES_ADJUSTED" BETWEEN 20 AND 200'
)
_VALID = '"CHLA_ADJUSTED" IS NOT NULL AND NOT isnan("CHLA_ADJUSTED")'


def _text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def _index(condition: str) -> str:
    return (
        f"WITH {_INDEX} SELECT ord, file, wmoid, latitude, longitude, {_text('date')} AS date "
        f"FROM v_index WHERE {condition}"
    )


def _levels(select: str) -> str:
    return f"WITH {_STAGED} {select}"


def _parameters(select: str) -> str:
    return f"WITH {_PARAMETERS} {select}"


def _obs(select: str) -> str:
    return f"WITH {_OBSERVATIONS} {select}"


_DEFAULT_AREA = "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"
_DEFAULT_DATES = "date BETWEEN TIMESTAMP '1900-01-01' AND TIMESTAMP '2200-01-01'"

_MODE_COLUMNS = ", ".join(
    f"CASE WHEN e.has_modes THEN coalesce(max(m.mode) FILTER (WHERE m.name = '{p}'), '') END "
    f'AS "{p}_DATA_MODE"'
    for p in ("TEMP", "PSAL", "DOXY", "CHLA")
)


def _absent(columns: tuple[str, ...], kind: str) -> str:
    return ", ".join(f'CAST(NULL AS {kind}) AS "{c}"' for c in columns)


_WRITTEN = 'SELECT "PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "PRES", "TEMP" FROM levels'


def _tail(key: str) -> str:
    """The last three parts of a customer's file path."""
    name = f"CAST(1900000 + {key} AS VARCHAR)"
    return f"{_centre(key)} || '/' || {name} || '/' || {name} || '_Sprof.nc'"


def oracle_sql() -> dict[str, str]:
    return {
        "index_extract": f"""WITH {_INDEX} SELECT ord, wmoid, cycle, filepath_main, filepath,
            filename, {_text('date')} AS date, {_text('date_update')} AS date_update
            FROM v_index""",
        "index_rejects": f"WITH {_INDEX} SELECT ord, file FROM v_index WHERE wmoid IS NULL",
        "index_scan": f"""WITH {_INDEX} SELECT file, {_text('date')} AS date, latitude,
            longitude, parameters, {_text('date_update')} AS date_update FROM v_index""",
        "index_scan_broken": f"""WITH {_INDEX} SELECT file, {_text('date')} AS date, latitude,
            longitude, parameters, {_text('date_update')} AS date_update FROM v_index
            WHERE ord % 101 <> 0 AND ord % 103 <> 0 AND ord % 109 <> 0""",
        "index_scan_rejects": f"""WITH {_INDEX} SELECT file, CAST(CASE WHEN ord % 101 = 0 THEN 3
            WHEN ord % 103 = 0 THEN 7 ELSE 6 END AS BIGINT) AS fields
            FROM v_index WHERE ord % 101 = 0 OR ord % 103 = 0 OR ord % 109 = 0""",
        "subset_default": _index(f"{_DEFAULT_AREA} AND {_DEFAULT_DATES}"),
        "subset_latlon": _index("latitude BETWEEN -20 AND 45 AND longitude BETWEEN -60 AND 30.5"),
        "subset_lon_wrap": _index(
            "latitude BETWEEN -10 AND 10 AND (longitude >= 170 OR longitude <= -170)"
        ),
        "subset_lon_360": f"""WITH {_INDEX} SELECT ord, longitude,
            CASE WHEN longitude < 0 THEN (longitude + 360) - 360 ELSE longitude END AS normalized
            FROM v_index WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -170 AND -160""",
        "subset_date": _index("date BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1999-12-31'"),
        "subset_floats": _index("wmoid IN (1900005, 1900050, 1900089)"),
        "subset_floats_table": _index(
            "wmoid IN (SELECT 1900000 + c_custkey FROM customer WHERE c_acctbal > 0)"
        ),
        "subset_sensors": _index(
            f"{_DEFAULT_AREA} AND {_DEFAULT_DATES} AND regexp_matches(parameters, 'CHLA') "
            "AND regexp_matches(parameters, 'DOXY')"
        ),
        "subset_sensors_exact": _index(
            f"{_DEFAULT_AREA} AND {_DEFAULT_DATES} "
            "AND list_contains(string_split(parameters, ' '), 'CHLA') "
            "AND list_contains(string_split(parameters, ' '), 'DOXY')"
        ),
        "float_list": f"""WITH {_INDEX} SELECT filepath_main, arg_min(wmoid, ord) AS wmoid
            FROM v_index WHERE filepath_main IS NOT NULL GROUP BY filepath_main""",
        "metadata_by_float": f"""WITH {_INDEX} SELECT ord, wmoid, cycle, filename, latitude,
            parameters FROM v_index WHERE wmoid = 1900899""",
        "month_label": f"""WITH {_INDEX} SELECT ord, strftime(date, '%Y-%m') AS month
            FROM v_index""",
        "candidates_float": f"""WITH {_INDEX}, {_candidates('v_index')}
            SELECT * FROM candidates""",
        "candidates_profile": f"""WITH {_INDEX} SELECT filepath, filename, wmoid,
            '/mirror/dac/' || filepath || filename AS local_path,
            'https://example.org/dac/' || filepath || filename AS url
            FROM v_index WHERE wmoid IS NOT NULL""",
        "path_tail": f"""WITH {_FILES} SELECT path,
            array_to_string(string_split(path, '/')[-3:], '/') AS tail FROM v_all_files""",
        "file_inventory_stats": f"""WITH {_FILES} SELECT count(*) AS files,
            round(sum(length) / (1024 * 1024), 6) AS total_mb FROM v_all_files""",
        "freshness": f"""WITH {_INDEX}, {_FILES}, {_candidates('v_index')}, {_states('v_index')}
            SELECT local_path, wmoid, state FROM states""",
        "refresh_action": f"""WITH {_INDEX}, {_FILES}, {_candidates('v_index')}
            SELECT local_path, {_BY_TIME} AS by_time,
              CASE WHEN mtime IS NOT NULL THEN 'keep'
                WHEN coalesce(status, 404) = 404 THEN 'missing_remote' ELSE 'fetch' END
                AS by_presence
            FROM candidates c LEFT JOIN v_files f ON c.local_path = f.path
            LEFT JOIN v_remote r ON c.url = r.url""",
        "refresh_plan": f"""WITH {_INDEX}, {_FILES},
            chosen AS (SELECT * FROM v_index WHERE wmoid IS NOT NULL AND {_DEFAULT_DATES}
              AND latitude BETWEEN -60 AND 60 AND longitude BETWEEN -180 AND 180),
            {_candidates('chosen')}, {_states('chosen')}
            SELECT local_path, state,
              CASE WHEN state = 'current' THEN 'keep' ELSE {_BY_TIME} END AS action
            FROM states s LEFT JOIN v_remote r ON s.url = r.url""",
        "flatten_levels": _levels(f"SELECT {_LEVEL_COLUMNS} FROM levels"),
        "flatten_drop_padding": _levels(
            f'SELECT {_LEVEL_COLUMNS} FROM levels WHERE "PRES" IS NOT NULL'
        ),
        "conform_schema": _levels(
            'SELECT "PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "CYCLE_NUMBER", "DIRECTION", '
            '"LATITUDE", "LONGITUDE", "JULD", "PRES", "TEMP", "TEMP_QC", '
            + _absent(("DATA_MODE",), "VARCHAR")
            + ", "
            + _absent(
                (
                    "POSITION_QC", "JULD_QC", "PRES_QC", "PRES_ADJUSTED_QC",
                    "TEMP_ADJUSTED_QC", "PSAL_QC", "PSAL_ADJUSTED_QC",
                ),
                "BIGINT",
            )
            + ", "
            + _absent(
                (
                    "PRES_ADJUSTED", "PRES_ADJUSTED_ERROR", "TEMP_ADJUSTED",
                    "TEMP_ADJUSTED_ERROR", "PSAL", "PSAL_ADJUSTED", "PSAL_ADJUSTED_ERROR",
                ),
                "DOUBLE",
            )
            + " FROM levels"
        ),
        "union_outer": _levels(
            'SELECT source_file, "N_PROF", "N_LEVELS", "PRES" FROM levels UNION ALL BY NAME '
            'SELECT source_file, "N_PROF", "N_LEVELS", "TEMP", "TEMP_QC" FROM levels'
        ),
        "write_roundtrip": _levels(
            'SELECT "PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "LATITUDE", "JULD", "PRES", "TEMP" '
            "FROM levels"
        ),
        "data_mode_spread": _parameters(
            f"""SELECT e.source_file, e.n_prof AS "N_PROF", {_MODE_COLUMNS}
            FROM (SELECT DISTINCT source_file, n_prof, has_modes FROM entries) e
            LEFT JOIN profile_modes m ON m.source_file = e.source_file AND m.n_prof = e.n_prof
            GROUP BY e.source_file, e.n_prof, e.has_modes"""
        ),
        "data_mode_unknown": _parameters(
            """SELECT DISTINCT source_file, name || '_DATA_MODE' AS "column" FROM entries
            WHERE has_modes AND name = 'FOO'"""
        ),
        "data_mode_invalid": _parameters(
            "SELECT source_file, CAST(NOT bad_mode AS BIGINT) AS valid FROM flags"
        ),
        "calib_invariant": _parameters(
            "SELECT source_file, CAST(NOT bad_calibration AS BIGINT) AS invariant FROM flags"
        ),
        "quarantine_files": _parameters(
            """SELECT source_file, CASE WHEN bad_calibration
              THEN 'PARAMETER differs between calibrations'
              ELSE 'data mode of a known parameter is longer than one character' END AS error
            FROM flags WHERE bad_calibration OR bad_mode"""
        ),
        "quarantine_levels": """WITH longest AS (
              SELECT o_custkey, o_orderkey, max((l_linenumber - 1) % 7) + 1 AS n
              FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)
            SELECT CAST(o_custkey AS VARCHAR) AS source_file,
              'level_count is missing or smaller than an array' AS error
            FROM longest GROUP BY o_custkey
            HAVING bool_or(CASE WHEN o_custkey % 5 = 0 THEN coalesce(n, 0) > 2
              ELSE o_custkey % 7 = 0 END)""",
        "flatten_uneven": """WITH longest AS (
              SELECT orders.*, coalesce(max((l_linenumber - 1) % 7) + 1, 0) AS n
              FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
            uneven AS (
              SELECT *, greatest(n, CASE WHEN o_custkey % 5 = 0 THEN 2
                WHEN o_custkey % 7 = 0 THEN 0 ELSE 7 + o_custkey % 3 END) AS rows FROM longest),
            """ + _STAGED.replace(
            "generate_series(0, 6 + o_custkey % 3)) AS lvl FROM orders",
            "generate_series(0, rows - 1)) AS lvl FROM uneven",
        ) + f" SELECT {_LEVEL_COLUMNS} FROM levels",
        "filter_in_float": _levels(
            """SELECT source_file, "N_PROF", "N_LEVELS", "TEMP" FROM levels
            WHERE "N_PROF" % 10 = 3 OR ("N_PROF" % 10 IN (1, 7) AND "TEMP" > 30)"""
        ),
        "quarantine_rest": _parameters(
            """SELECT DISTINCT source_file, n_prof AS "N_PROF" FROM entries
            WHERE source_file NOT IN (
              SELECT source_file FROM flags WHERE bad_calibration OR bad_mode)"""
        ),
        "failure_rate": _parameters(
            """SELECT count(*) AS files, count(*) FILTER (WHERE bad_calibration OR bad_mode)
              AS failed,
              round(count(*) FILTER (WHERE bad_calibration OR bad_mode) * 100 / count(*), 6)
              AS failed_percent
            FROM flags"""
        ),
        "verify_data_mode": _parameters(
            """SELECT m.source_file, m.n_prof AS "N_PROF", m.name AS parameter,
              CAST(1 AS BIGINT) AS matches
            FROM profile_modes m JOIN flags f ON m.source_file = f.source_file
            WHERE NOT (bad_calibration OR bad_mode)"""
        ),
        "convert_pipeline": _parameters(
            """, numbered AS (
              SELECT *, row_number() OVER (PARTITION BY source_file, n_prof ORDER BY event_id)
                - 1 AS lvl
              FROM entries),
            lengths AS (
              SELECT source_file, max(lvl) AS last FROM numbered GROUP BY source_file),
            grid AS (
              SELECT e.source_file, e.user_id, e.n_prof, e.has_modes,
                unnest(generate_series(0, last)) AS lvl
              FROM (SELECT DISTINCT source_file, user_id, n_prof, has_modes FROM entries) e
              JOIN lengths l ON e.source_file = l.source_file
              JOIN flags f ON e.source_file = f.source_file
              WHERE NOT (bad_calibration OR bad_mode))
            SELECT g.user_id AS "PLATFORM_NUMBER", g.n_prof AS "N_PROF",
              CAST(g.lvl AS BIGINT) AS "N_LEVELS",
              CAST(CAST(n.value AS FLOAT) AS DOUBLE) AS "TEMP",
              CASE WHEN g.has_modes THEN coalesce(m.mode, '') END AS "TEMP_DATA_MODE",
              CAST(NULL AS DOUBLE) AS "CHLA"
            FROM grid g
            LEFT JOIN numbered n ON n.source_file = g.source_file AND n.n_prof = g.n_prof
              AND n.lvl = g.lvl
            LEFT JOIN profile_modes m ON m.source_file = g.source_file AND m.n_prof = g.n_prof
              AND m.name = 'TEMP'"""
        ),
        "decode_profiles": f"""SELECT {_tail('o_custkey')} AS tail, o_orderkey AS "N_PROF",
            CAST(o_orderkey % 97 AS DOUBLE) AS "PRES"
            FROM orders WHERE o_custkey % 17 <> 0""",
        "decode_failures": f"""SELECT DISTINCT {_tail('o_custkey')} AS tail
            FROM orders WHERE o_custkey % 17 = 0""",
        "inventory_scan": f"""SELECT {_tail('o_custkey')} AS tail,
            CASE WHEN o_custkey % 17 = 0 THEN 6 ELSE
              sum(strlen(o_orderkey || ',' || o_orderkey % 97)) + count(*) - 1
            END::BIGINT AS length
            FROM orders GROUP BY o_custkey""",
        "staged_scan": _levels(f"SELECT {_LEVEL_COLUMNS} FROM levels"),
        "convert_subset": f"""WITH {_INDEX}, floats AS (
              SELECT DISTINCT filepath_main FROM v_index
              WHERE wmoid IS NOT NULL AND latitude BETWEEN -60 AND 60 AND longitude IS NOT NULL
                AND date IS NOT NULL)
            SELECT 1900000 + o_custkey AS "PLATFORM_NUMBER", o_orderkey AS "N_PROF",
              CAST(0 AS BIGINT) AS "N_LEVELS", CAST(o_orderkey % 97 AS DOUBLE) AS "PRES"
            FROM orders WHERE o_custkey % 17 <> 0
              AND {_centre('o_custkey')} || '/' || CAST(1900000 + o_custkey AS VARCHAR) || '/'
                IN (SELECT filepath_main FROM floats)""",
        "write_append": _levels(_WRITTEN),
        "write_sized": _levels(_WRITTEN),
        "batch_twice": _levels(_WRITTEN),
        "skipping_read": _obs(
            f"""SELECT event_id, {_text('"JULD"')} AS "JULD", "PRES_ADJUSTED" FROM v_obs
            WHERE {_BOX} AND {_TIME_DEPTH}"""
        ),
        "two_schemas": _obs(
            """SELECT event_id, CAST("CHLA_ADJUSTED_QC" AS BIGINT) AS "CHLA_ADJUSTED_QC",
              CASE WHEN event_id % 2 = 1 THEN "PRES_ADJUSTED" END AS "PRES_ADJUSTED" FROM v_obs"""
        ),
        "stream_convert": _levels(_WRITTEN),
        "sketch_limits": _obs(
            """SELECT q::DOUBLE AS q, (count(*) FILTER (WHERE "CHLA_ADJUSTED" IS NOT NULL) > 0)::BIGINT AS within
            FROM v_obs, (VALUES (0.01), (0.5), (0.99)) AS wanted(q) GROUP BY q"""
        ),
        "schema_roundtrip": _levels(_WRITTEN),
        "filter_dnf": _obs(
            """SELECT event_id, "LATITUDE", "PRES_ADJUSTED" FROM v_obs
            WHERE ("LATITUDE" > 50 AND "CHLA_ADJUSTED" >= 0.5 AND NOT isnan("CHLA_ADJUSTED"))
              OR ("PRES_ADJUSTED" < 5 AND "CHLA_ADJUSTED_QC" IN (1, 2))"""
        ),
        "filter_not_in": f"""WITH {_INDEX}, bands AS (
            SELECT ord, CAST(floor(latitude / 30) AS BIGINT) AS band FROM v_index)
            SELECT ord, band FROM bands WHERE band IS NULL OR band NOT IN (0, 1)""",
        "filter_in_null": f"""WITH {_INDEX}, bands AS (
            SELECT ord, CAST(floor(latitude / 30) AS BIGINT) AS band FROM v_index)
            SELECT ord, band FROM bands WHERE band IS NULL OR band = 2""",
        "box_filter": _obs(f'SELECT event_id, "LATITUDE", "LONGITUDE" FROM v_obs WHERE {_BOX}'),
        "box_time_depth": _obs(
            f"""SELECT event_id, {_text('"JULD"')} AS "JULD", "PRES_ADJUSTED" FROM v_obs
            WHERE {_BOX} AND {_TIME_DEPTH}"""
        ),
        "valid_values": _obs(f'SELECT event_id, "CHLA_ADJUSTED" FROM v_obs WHERE {_VALID}'),
        "qc_filter": _obs(
            """SELECT event_id, "CHLA_ADJUSTED_QC" FROM v_obs
            WHERE "CHLA_ADJUSTED_QC" IN (1, 2)"""
        ),
        "map_rows": _obs(
            f"""SELECT "CHLA_ADJUSTED", "LATITUDE", "LONGITUDE", "PRES_ADJUSTED",
              {_text('"JULD"')} AS "JULD"
            FROM v_obs WHERE {_BOX} AND {_TIME_DEPTH} AND {_VALID}"""
        ),
        "map_mean": _obs(
            f"""SELECT "LATITUDE", "LONGITUDE", round(avg("CHLA_ADJUSTED"), 6) AS "CHLA_ADJUSTED"
            FROM v_obs WHERE {_BOX} AND {_TIME_DEPTH} AND {_VALID}
            GROUP BY "LATITUDE", "LONGITUDE" """
        ),
        "map_limits": _obs(
            f"""SELECT round(quantile_cont("CHLA_ADJUSTED", 0.01), 9) AS lower,
              round(quantile_cont("CHLA_ADJUSTED", 0.99), 9) AS upper
            FROM v_obs WHERE {_BOX} AND {_TIME_DEPTH} AND {_VALID}"""
        ),
        "head_rows": _obs(
            f"""SELECT event_id, {_text('"JULD"')} AS "JULD", "LATITUDE"
            FROM v_obs ORDER BY event_id LIMIT 5"""
        ),
    }
