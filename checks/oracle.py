"""SQL counterparts of the registered queries, written independently of their Spark form."""

from __future__ import annotations

from checks.views import EDGE_YEARS, VIEWS, sql_view

# Names and lists of the data model, spelled out here so that the package's own lists are checked, too.
SLOTS = ("manu_1", "fert_1", "manu_2", "fert_2", "manu_3", "fert_3")
SLOT_DAYS = [f"{s[:4]}_daytoplanting_{s[5]}" for s in SLOTS]
SLOT_AMOUNTS = ["manu_amount_1", "manu_amount_2", "manu_amount_3", "fert_amount_1", "fert_amount_2", "fert_amount_3"]
EVENT_COLUMNS = [f"{label}_{s}" for s in SLOTS for label in ("total_precipitation_7_before", "total_precipitation_3_after")]
CODED = ["soil", "climate", "cropping_systems", "crop_rotation", "n_synth_type", "n_org_type", "n_org_replication",
         "n_synth_replication", "irrigation", "manu_depth", "n_org_amount", "n_synthamount"]
TARGETS = ("n2o", "no3", "yield", "soc")
FIXED_POWER = 0.7
CELLS = {"winter": {"growing_season": (10, 11, 12, 1, 2, 3, 4, 5, 6, 7), "autumn": (10, 11), "winter": (12, 1, 2),
                    "spring": (3, 4, 5)},
         "spring": {"growing_season": (3, 4, 5, 6, 7, 8), "spring": (3, 4, 5), "summer": (6, 7, 8)}}


def listed(items) -> str:
    return ", ".join(map(str, items))


def seasonal(crop: str) -> str:
    """Separate aggregates per season, left-joined to the yearly one."""
    year = "CAST(YEAR(date) + CASE WHEN MONTH(date) >= 10 THEN 1 ELSE 0 END AS INT)" if crop == "winter" \
        else "CAST(YEAR(date) AS INT)"
    sums = "SUM(COALESCE(prec, 0)) AS p, SUM(COALESCE(tavg, 0)) AS t"
    columns, joins = [], []
    for season, months in CELLS[crop].items():
        columns.append(f"{season}.p AS total_precipitation_{season}, {season}.t AS total_average_temperature_{season}")
        joins.append(
            f"LEFT JOIN (SELECT id, {year} AS harvest_year, {sums} FROM fx_climate "
            f"WHERE MONTH(date) IN ({listed(months)}) GROUP BY 1, 2) {season} "
            f"ON {season}.id = y.id AND {season}.harvest_year = y.harvest_year"
        )
    return (
        f"SELECT y.id, y.harvest_year, y.p AS total_precipitation_year, y.t AS total_average_temperature_year, "
        f"{listed(columns)} FROM (SELECT id, {year} AS harvest_year, {sums} FROM fx_climate GROUP BY 1, 2) y "
        f"{' '.join(joins)} WHERE y.harvest_year NOT IN ({listed(EDGE_YEARS)})"
    )


CLASS_CASE = (
    "CASE WHEN aridity_index >= 28 AND aridity_index <= CAST(31.05 AS DOUBLE) THEN '1' "
    "WHEN aridity_index >= CAST(31.06 AS DOUBLE) AND aridity_index <= 35 THEN '2' "
    "WHEN aridity_index > 35 AND aridity_index <= 45 THEN '3' "
    "WHEN aridity_index > 45 AND aridity_index <= 55 THEN '4' ELSE 'Unknown' END"
)

RESET = {"n_org_type": ("n_org_amount", "NULL"), "n_org_replication": ("n_org_amount", "0"),
         "n_synth_type": ("n_synthamount", "NULL"), "n_synth_replication": ("n_synthamount", "0")}
for _n in (1, 2, 3):
    RESET |= {f"manu_daytoplanting_{_n}": ("n_org_amount", "NULL"), f"manu_amount_{_n}": ("n_org_amount", "0"),
              f"fert_daytoplanting_{_n}": ("n_synthamount", "NULL"), f"fert_amount_{_n}": ("n_synthamount", "0")}
RESET_SQL = "SELECT * REPLACE ({}) FROM fx_outputs".format(
    listed(f"CASE WHEN {amount} = 0 THEN {value} ELSE {c} END AS {c}" for c, (amount, value) in RESET.items())
)
DRY_MATTER = "yield_c * (CAST(1 AS DOUBLE) / CAST(0.45 AS DOUBLE))"
FILTER_SQL = f"""
SELECT *, {DRY_MATTER} AS yield_dm FROM o_reset
WHERE NOT COALESCE({DRY_MATTER} < 1000, FALSE)
  AND NOT COALESCE(n_synthamount <= 140 AND n_synth_replication > 2, FALSE)
  AND NOT COALESCE(n_org_amount <= 140 AND n_org_replication > 2, FALSE)
  AND NOT COALESCE(n_synthamount < 70 AND n_synth_replication > 1, FALSE)
  AND NOT COALESCE(n_synthamount >= 70 AND n_synthamount <= 140 AND n_synth_replication > 2, FALSE)
"""


def backfill(source: str) -> str:
    once = {"manu_amount_1": ("n_org_replication", "n_org_amount"),
            "fert_amount_1": ("n_synth_replication", "n_synthamount"),
            "manu_daytoplanting_1": ("n_org_replication", "manu_daytoplanting"),
            "fert_daytoplanting_1": ("n_synth_replication", "fert_daytoplanting")}
    edits = listed(f"CASE WHEN {rep} = 1 THEN {src} ELSE {c} END AS {c}" for c, (rep, src) in once.items())
    return f"SELECT * REPLACE ({edits}) FROM {source}"


KEPT = ["id", "year", "n_org_amount", "n_synthamount", "n_org_replication", "n_synth_replication", *SLOT_DAYS,
        *SLOT_AMOUNTS, "planting_dayofyear", "harvest_dayofyear", "soil", "irrigation", "climate",
        "cropping_systems", "crop_rotation", "manu_depth"]
CLEAN_SQL = f"""
SELECT {listed(KEPT)}, CASE WHEN n_org_type = 'none' THEN NULL ELSE n_org_type END AS n_org_type,
       CASE WHEN n_synth_type = 'none' THEN NULL ELSE n_synth_type END AS n_synth_type,
       yield_dm AS "yield", n2o_raw AS n2o, no3_raw AS no3, soc_raw AS soc,
       n_org_amount + n_synthamount AS total_nitrogen
FROM o_filled
"""


def event_day(slot: str) -> str:
    offset = f"{slot[:4]}_daytoplanting_{slot[5]}"
    return f"CAST(MAKE_DATE(year - 1, 1, 1) + CAST(planting_dayofyear - 1 + FLOOR({offset}) AS INT) AS DATE)"


def event_rows(panel: str, per_year: bool = False, order: str = "year, climate_id") -> str:
    """Dated event slots of each key's first row."""
    parts = " UNION ALL ".join(
        f"SELECT id, year, climate_id, '{s}' AS slot, {event_day(s)} AS event_date FROM firsts" for s in SLOTS
    )
    keys = "id, year" if per_year else "id"
    return (
        f"SELECT * FROM (WITH firsts AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} "
        f"ORDER BY {order}) AS nth FROM {panel}) WHERE nth = 1) {parts})"
    )


def event_sums(rows: str, per_year: bool = False, climate: str = "fx_climate") -> str:
    """Range join of event slots and climate days of the same calendar year."""
    keys = ["id", "year"] if per_year else ["id"]
    windows = {"total_precipitation_7_before": (-7, 0), "total_precipitation_3_after": (0, 3)}
    sums = listed(
        f"SUM(CASE WHEN e.slot = '{s}' AND DAYOFYEAR(c.date) - DAYOFYEAR(e.event_date) BETWEEN {a} AND {b} "
        f"THEN c.prec END) AS {label}_{s}"
        for s in SLOTS for label, (a, b) in windows.items()
    )
    return (
        f"SELECT {listed('e.' + k for k in keys)}, {sums} FROM {rows} e LEFT JOIN {climate} c "
        f"ON c.id = e.climate_id AND YEAR(c.date) = YEAR(e.event_date) "
        f"AND DAYOFYEAR(c.date) BETWEEN DAYOFYEAR(e.event_date) - 7 AND DAYOFYEAR(e.event_date) + 3 "
        f"GROUP BY {listed('e.' + k for k in keys)}"
    )


SEASON_COLUMNS = [f"total_{m}_{s}" for s in ("year", *CELLS["winter"]) for m in ("precipitation", "average_temperature")]
ENRICHED_SQL = f"""
SELECT p.*, s.event_id, s.climate_id, s.site_id, s.setup_id, f.harvest_year, f.class, {listed(SEASON_COLUMNS)},
       g.clay, g.JB_Classes AS jb_classes, d.prec_days
FROM o_clean p
JOIN fx_sims s ON p.id = s.event_id
JOIN o_class_features f ON f.id = s.climate_id AND f.harvest_year = p.year
JOIN fx_soil g ON g.site_id = s.site_id
JOIN o_prec_days d ON d.climate_id = s.climate_id AND d.year = p.year
"""
RATIO = (
    "CAST(COALESCE(n_synthamount / NULLIF(n_synthamount + n_org_amount, 0), 0) AS FLOAT)"
)
CATEGORY_SOURCE = {c: c for c in CODED} | {
    c: f"COALESCE({c}, 'No Application')" for c in ("n_org_type", "n_synth_type")
}


def codes(source: dict[str, str]) -> str:
    return listed(
        f"CASE WHEN {e} IS NULL THEN -1 ELSE CAST(DENSE_RANK() OVER (ORDER BY {e} ASC NULLS LAST) - 1 AS INT) END AS {c}"
        for c, e in source.items()
    )


SQUARES = ["fert_amount_1", "fert_amount_2", "fert_amount_3", "manu_amount_1", "manu_amount_2", "manu_amount_3", "total_nitrogen"]
TRAINING_COLUMNS = {
    "id": "p.id", "year": "p.year",
    **{t: f"COALESCE(p.{t}, 0)" for t in ("n2o", "no3", "soc")},
    **{c: f"p.{c}" for c in CODED},
    **{c: f"COALESCE(p.{c}, 0)" for c in SQUARES},
    **{f"{c}_sq": f"COALESCE(p.{c} * p.{c}, 0)" for c in SQUARES},
    **{c: f"p.{c}" for c in (*SEASON_COLUMNS, "clay", "prec_days")},
    "precipitation_clay_interaction": "p.total_precipitation_growing_season * p.clay",
    "precip_n_interaction": "p.total_precipitation_growing_season * p.total_nitrogen",
    **{c: f"COALESCE(w.{c}, -1)" for c in EVENT_COLUMNS},
    "yield": 'ROUND(COALESCE(p."yield", 0), 6)', "synth_org_ratio": "ROUND(CAST(p.ratio AS DOUBLE), 6)",
}
TRAINING_SQL = (
    "SELECT " + listed(f'{e} AS "{c}"' for c, e in TRAINING_COLUMNS.items())
    + f" FROM (SELECT * REPLACE ({codes(CATEGORY_SOURCE)}), {RATIO} AS ratio FROM o_enriched) p JOIN o_enriched_windows w USING (id)"
)

DERIVED = {
    "o_prec_days": "SELECT id AS climate_id, CAST(YEAR(date) AS INT) AS year, "
    "CAST(SUM(CASE WHEN prec > 0 THEN 1 ELSE 0 END) AS BIGINT) AS prec_days FROM fx_climate GROUP BY 1, 2",
    "o_winter": seasonal("winter"),
    "o_classes": f"SELECT id, {CLASS_CASE} AS class FROM fx_classes",
    "o_class_features": "SELECT f.*, c.class FROM o_winter f JOIN o_classes c ON c.id = f.id",
    "o_reset": RESET_SQL,
    "o_accepted": FILTER_SQL,
    "o_filled": backfill("o_accepted"),
    "o_clean": CLEAN_SQL,
    "o_panel": "SELECT *, (id // 100 + id % 100 * 31) % (SELECT COUNT(*) FROM supplier) AS climate_id FROM fx_outputs",
    "o_tied_panel": "SELECT * REPLACE (id // 100 AS id), id // 100 % 7 AS climate_id FROM fx_outputs",
    "o_tied_slots": event_rows("o_tied_panel", order="year, climate_id, " + listed(f"{event_day(s)} ASC NULLS FIRST" for s in SLOTS)),
    "o_slots": event_rows("o_panel"),
    "o_slots_by_year": event_rows("o_panel", True),
    "o_windows": event_sums("o_slots"),
    "o_enriched": ENRICHED_SQL,
    "o_enriched_slots": event_rows("o_enriched"),
    "o_enriched_windows": event_sums("o_enriched_slots"),
    "o_training": TRAINING_SQL,
    "o_targets": 'SELECT id, year, COALESCE(n2o, 0) AS n2o, COALESCE(no3, 0) AS no3, COALESCE("yield", 0) AS yield_dm, '
    "COALESCE(soc, 0) AS soc FROM o_clean",
    "o_metrics": "SELECT target, fold, COUNT(*) AS n, SQRT(AVG((y_pred - y) * (y_pred - y))) AS rmse, "
    "AVG(ABS(y_pred - y)) AS mae, 1 - SUM((y_pred - y) * (y_pred - y)) / (COUNT(*) * VAR_POP(y)) AS r2 "
    "FROM fx_predictions GROUP BY target, fold",
}


def with_views(body: str, first: str = "") -> str:
    """``body`` with the views it needs in front as common table expressions."""
    texts = {n: sql_view(n) for n in VIEWS} | DERIVED
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in texts:
            if _mentions(text, name) and name not in needed:
                visit(texts[name])
                needed.append(name)

    visit(first + " " + body)
    ctes = [f"{n} AS ({texts[n].strip()})" for n in needed]
    parts = [*ctes, *([first.strip()] if first else [])]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _mentions(text: str, name: str) -> bool:
    at = text.find(name)
    while at >= 0:
        before = text[at - 1] if at else " "
        after = text[at + len(name)] if at + len(name) < len(text) else " "
        if not (before.isalnum() or before == "_" or after.isalnum() or after == "_"):
            return True
        at = text.find(name, at + 1)
    return False


def rounded(columns, digits: int = 6) -> str:
    return listed(f"ROUND({c}, {digits}) AS {c}" for c in columns)


# Greedy grouped folds: the list of group sizes, heaviest first, is folded into the five loads,
# each size going to the first of the lightest.
_gains = listed(f"a[{i}] + CASE WHEN LIST_POSITION(a, LIST_MIN(a)) = {i} THEN x[1] ELSE 0 END" for i in range(1, 6))
GREEDY = f"""
sized AS (SELECT COUNT(*) AS w FROM {{rows}} GROUP BY id),
steps AS (SELECT LIST([CAST(w AS BIGINT)] ORDER BY w DESC) AS ws FROM sized),
given AS (SELECT LIST_REDUCE(LIST_PREPEND([CAST(0 AS BIGINT), 0, 0, 0, 0], ws), LAMBDA a, x : [{_gains}]) AS loads
          FROM steps)
"""

def _powers(grid: str, prefix: str, step: float) -> str:
    """Best power of a grid by profile likelihood, refined by a parabola through its neighbours."""
    return f"""
{prefix}_curves AS (
  SELECT lam, n, x, CASE WHEN x >= 0 AND lam = 0 THEN LN(1 + x)
    WHEN x >= 0 THEN (POWER(1 + x, lam) - 1) / lam
    WHEN lam = 2 THEN -LN(1 - x) ELSE -(POWER(1 - x, 2 - lam) - 1) / (2 - lam) END AS y
  FROM vals CROSS JOIN ({grid})),
{prefix}_means AS (SELECT lam, SUM(n) AS m, SUM(n * y) / SUM(n) AS mu, SUM(n * SIGN(x) * LN(1 + ABS(x))) / SUM(n) AS j
          FROM {prefix}_curves GROUP BY lam),
{prefix}_scored AS (
  SELECT c.lam, -0.5 * LN(SUM(c.n * (c.y - mu) * (c.y - mu)) / ANY_VALUE(m)) + (c.lam - 1) * ANY_VALUE(j) AS ll
  FROM {prefix}_curves c JOIN {prefix}_means USING (lam) GROUP BY c.lam),
{prefix}_near AS (SELECT lam, ll, LAG(ll) OVER (ORDER BY lam) AS a, LEAD(ll) OVER (ORDER BY lam) AS b FROM {prefix}_scored),
{prefix}_best AS (SELECT lam + {step} / 2 * (a - b) / (a - 2 * ll + b) AS lam FROM {prefix}_near ORDER BY ll DESC LIMIT 1)"""


# One split with penalties: every cut of every feature, missing values on either side.
STUMP = """
stump_rows AS (
  SELECT manu_daytoplanting_1 AS a, manu_amount_1 AS b, n_org_amount AS c,
         no3_raw + CASE WHEN manu_daytoplanting_1 IS NULL OR manu_daytoplanting_1 >= 10 THEN 100 ELSE 0 END AS y FROM fx_outputs),
stump_base AS (SELECT AVG(y) AS m FROM stump_rows),
stump_long AS (
  SELECT f, CASE f WHEN 0 THEN a WHEN 1 THEN b ELSE c END AS v, COUNT(*) AS n, SUM(m - y) AS g
  FROM stump_rows, stump_base, RANGE(3) r(f) GROUP BY ALL),
stump_tried AS (
  SELECT cut.f, cut.v, side, SUM(d.n) AS n, SUM(d.g) AS g,
         SUM(CASE WHEN d.v <= cut.v OR d.v IS NULL AND side = 1 THEN d.n ELSE 0 END) AS nl,
         SUM(CASE WHEN d.v <= cut.v OR d.v IS NULL AND side = 1 THEN d.g ELSE 0 END) AS gl
  FROM stump_long cut JOIN stump_long d ON cut.f = d.f, RANGE(2) s(side) WHERE cut.v IS NOT NULL GROUP BY ALL),
stump_best AS (
  SELECT * FROM stump_tried WHERE nl > 0 AND nl < n
  ORDER BY POWER(GREATEST(ABS(gl) - 5, 0), 2) / (nl + 2) + POWER(GREATEST(ABS(g - gl) - 5, 0), 2) / (n - nl + 2)
           - POWER(GREATEST(ABS(g) - 5, 0), 2) / (n + 2) DESC, f, v, side LIMIT 1),
stump_sides AS (
  SELECT y, CASE f WHEN 0 THEN a WHEN 1 THEN b ELSE c END <= v OR CASE f WHEN 0 THEN a WHEN 1 THEN b ELSE c END IS NULL AND side = 1 AS l
  FROM stump_rows, stump_best),
stump_leaves AS (
  SELECT ROUND(m - SIGN(s.g) * GREATEST(ABS(s.g) - 5, 0) / (s.n + 2), 6) AS y_pred, s.n, ROUND(s.mean_y, 6) AS mean_y
  FROM stump_base, (SELECT COALESCE(l, FALSE) AS l, COUNT(*) AS n, AVG(y) AS mean_y, SUM(m - y) AS g
                    FROM stump_sides, stump_base GROUP BY 1) s)
"""

# A coarse grid over all powers, then a fine one around its best.
YJ_FIT = f"""
vals AS (SELECT soc AS x, COUNT(*) AS n FROM o_targets GROUP BY soc),
{_powers("SELECT CAST(i AS DOUBLE) / 1000 - 2 AS lam FROM RANGE(0, 6001) g(i)", "coarse", 0.001)},
{_powers("SELECT lam + CAST(i AS DOUBLE) / 50000 AS lam FROM coarse_best, RANGE(-50, 51) g(i)", "fine", 0.00002)},
final AS (SELECT lam, n, CASE WHEN x >= 0 THEN (POWER(1 + x, lam) - 1) / lam
                              ELSE -(POWER(1 - x, 2 - lam) - 1) / (2 - lam) END AS y FROM vals CROSS JOIN fine_best)
"""

_pos = f"(POWER(1 + soc, {FIXED_POWER}) - 1) / {FIXED_POWER}"
_neg = f"-(POWER(1 - soc, 2 - {FIXED_POWER}) - 1) / (2 - {FIXED_POWER})"
DATES = {s: f"{s[:4]}_date_{s[5]}" for s in SLOTS}
DATE_TEXT = listed(f"CAST({event_day(s)} AS VARCHAR) AS {c}" for s, c in DATES.items())
CLEAN_REST = [c for c in (*KEPT, "n_org_type", "n_synth_type", "n2o", "no3", "soc", "total_nitrogen")]
ENRICH_REST = [*CLEAN_REST, "event_id", "climate_id", "site_id", "setup_id", "harvest_year", "class", *SEASON_COLUMNS,
               "clay", "jb_classes", "prec_days"]
DICTIONARY = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(ROW_NUMBER() OVER (ORDER BY v) - 1 AS INT) AS code, CAST(v AS VARCHAR) AS value "
    f"FROM (SELECT DISTINCT {c} AS v FROM o_clean WHERE {c} IS NOT NULL)"
    for c in CODED
)
UNKNOWN = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(v AS VARCHAR) AS value FROM (SELECT DISTINCT {c} AS v FROM o_clean "
    f"WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM o_clean WHERE year = 1996 AND {c} IS NOT NULL))"
    for c in CODED
)
REPORT = """
SELECT target, CAST(fold AS VARCHAR) AS fold, ROUND(rmse, 6) AS rmse, ROUND(mae, 6) AS mae, ROUND(r2, 6) AS r2 FROM o_metrics
UNION ALL
SELECT target, 'OOF', ROUND(AVG(rmse), 6), ROUND(AVG(mae), 6), ROUND(AVG(r2), 6) FROM o_metrics GROUP BY target
"""
_features = [c for c in TRAINING_COLUMNS if c not in ("id", *TARGETS)]

ORACLE: dict[str, str] = {
    "scan_climate_normalised": with_views("SELECT id, CAST(date AS VARCHAR) AS date, prec, tavg FROM fx_climate"),
    "scan_project_filter": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
    "WHERE o_totalprice > 200000 AND o_orderstatus = 'F'",
    "sorted_limit": with_views(
        "SELECT id, year, n_org_amount, n_synthamount FROM fx_outputs ORDER BY id, year LIMIT 1000"),
    "csv_to_parquet_roundtrip": with_views("SELECT * FROM fx_outputs"),
    "split_parquet_roundtrip": with_views("SELECT id, year, soil, n_org_amount FROM fx_outputs"),
    "csv_climate_scan": with_views("SELECT 'A' || id AS id, CAST(date AS VARCHAR) AS date, prec, tavg FROM fx_climate"),
    "csv_class_scan": with_views("SELECT id, aridity_index FROM fx_classes"),
    "csv_inferred_types": with_views(
        "SELECT id, year, planting_dayofyear, id * 7 % 1000 AS lot, CAST(id % 8 AS DOUBLE) / 4 AS share, "
        "CAST(CAST(DATE '2001-01-31' + CAST(id % 400 AS INT) AS DATE) AS VARCHAR) AS seen_on, id % 2 = 0 AS even, "
        "CASE WHEN id % 5 = 0 THEN 'x9' ELSE CAST(id % 5 AS VARCHAR) END AS mixed FROM fx_outputs"),
    "join_with_overlap": with_views(
        "SELECT a.id, a.year, a.n_org_amount AS n_org_amount_x, a.soil, b.n_synthamount AS n_org_amount_y, b.climate "
        "FROM fx_outputs a JOIN fx_outputs b ON a.id = b.id AND a.year = b.year"),
    "calendar_parts": with_views(
        "SELECT id, CAST(date AS VARCHAR) AS date, CAST(YEAR(date) AS INT) AS year, CAST(MONTH(date) AS INT) AS month, "
        "CAST(DAYOFYEAR(date) AS INT) AS doy FROM fx_climate"),
    "prec_days": with_views("SELECT * FROM o_prec_days"),
    "seasonal_winter": with_views("SELECT * FROM o_winter"),
    "seasonal_spring": with_views(seasonal("spring")),
    "rolling_precip": with_views(
        "SELECT a.id, CAST(a.date AS VARCHAR) AS date, "
        "SUM(CASE WHEN b.date <= a.date AND b.date >= a.date - 7 THEN b.prec END) AS prec_before, "
        "SUM(CASE WHEN b.date >= a.date AND b.date <= a.date + 3 THEN b.prec END) AS prec_after "
        "FROM fx_climate a JOIN fx_climate b ON a.id = b.id AND YEAR(a.date) = YEAR(b.date) GROUP BY a.id, a.date"),
    "range_classify": with_views(f"SELECT id, aridity_index, {CLASS_CASE} AS class FROM fx_classes"),
    "climate_class_join": with_views("SELECT * FROM o_class_features"),
    "simulation_climate_left": with_views(
        f"SELECT s.event_id, s.climate_id, s.site_id, s.setup_id, f.harvest_year, f.class, {listed(SEASON_COLUMNS)} "
        "FROM fx_sims s LEFT JOIN o_class_features f ON f.id = s.climate_id"),
    "zero_application_reset": with_views(
        "SELECT id, year, n_org_amount, n_synthamount, n_org_type, n_synth_type, n_org_replication, "
        f"n_synth_replication, {listed(SLOT_DAYS)}, {listed(SLOT_AMOUNTS)} FROM o_reset"),
    "unit_convert": with_views(f"SELECT id, year, ROUND({DRY_MATTER}, 6) AS yield_dm FROM fx_outputs"),
    "quality_filter": with_views(
        "SELECT id, year, n_org_amount, n_synthamount, n_org_replication, n_synth_replication FROM o_accepted"),
    "single_application_backfill": with_views(
        "SELECT id, year, manu_amount_1, fert_amount_1, manu_daytoplanting_1, fert_daytoplanting_1 "
        f"FROM ({backfill('fx_outputs')})"),
    "sentinel_to_null": with_views(
        "SELECT id, year, NULLIF(n_org_type, 'none') AS n_org_type, NULLIF(n_synth_type, 'none') AS n_synth_type "
        "FROM fx_outputs"),
    "derive_totals_cast": with_views(
        "SELECT id, year, n_org_amount, n_synthamount, n_org_amount + n_synthamount AS total_nitrogen, "
        "planting_dayofyear, harvest_dayofyear FROM fx_outputs"),
    "clean_panel": with_views(f'SELECT {listed(CLEAN_REST)}, ROUND("yield", 6) AS "yield" FROM o_clean'),
    "id_count_histogram": with_views(
        "SELECT rows_per_id, COUNT(*) AS ids FROM (SELECT id, COUNT(*) AS rows_per_id FROM o_clean GROUP BY id) "
        "GROUP BY rows_per_id"),
    "event_dates": with_views(f"SELECT id, year, {DATE_TEXT} FROM fx_outputs"),
    "dedupe_keep_first": with_views(
        "SELECT id, year, n_org_amount, n_org_type, soil, planting_dayofyear FROM fx_outputs o "
        "WHERE year = (SELECT MIN(year) FROM fx_outputs i WHERE i.id = o.id)"),
    "event_window_precip": with_views("SELECT * FROM o_windows"),
    "event_window_precip_by_cell_day": with_views("SELECT * FROM o_windows"),
    "event_window_precip_by_range": with_views("SELECT * FROM o_windows"),
    "event_window_precip_by_year": with_views(event_sums("o_slots_by_year", True)),
    "event_window_precip_ties": with_views(event_sums("o_tied_slots")),
    "event_window_empty": with_views(
        f"SELECT DISTINCT id, {listed(f'CAST(NULL AS DOUBLE) AS {c}' for c in EVENT_COLUMNS)} FROM fx_outputs"),
    "event_features_joined": with_views(
        f"SELECT p.id, p.year, p.climate_id, {listed(EVENT_COLUMNS)} FROM o_panel p JOIN o_windows w ON w.id = p.id"),
    "enrich_chain": with_views(f'SELECT {listed(ENRICH_REST)}, ROUND("yield", 6) AS "yield" FROM o_enriched'),
    "null_fill_policy": with_views(
        "SELECT id, year, COALESCE(n_org_type, 'No Application') AS n_org_type, "
        "COALESCE(n_synth_type, 'No Application') AS n_synth_type, COALESCE(n2o, 0) AS n2o, COALESCE(no3, 0) AS no3, "
        'ROUND(COALESCE("yield", 0), 6) AS "yield", COALESCE(soc, 0) AS soc FROM o_clean'),
    "ensure_columns": with_views(
        f"SELECT id, year, COALESCE(manu_amount_3, -1) AS {EVENT_COLUMNS[0]}, "
        f"{listed(f'CAST(-1 AS DOUBLE) AS {c}' for c in EVENT_COLUMNS[1:])} FROM fx_outputs"),
    "engineered_features": with_views(
        f"SELECT id, year, ROUND(CAST({RATIO} AS DOUBLE), 6) AS synth_org_ratio, "
        "ROUND(total_precipitation_growing_season * clay, 6) AS precipitation_clay_interaction, "
        "ROUND(total_precipitation_growing_season * total_nitrogen, 6) AS precip_n_interaction FROM o_enriched"),
    "squared_features": with_views(
        "SELECT id, year, " + listed(f"COALESCE({c}, 0) AS {c}, COALESCE({c} * {c}, 0) AS {c}_sq" for c in SQUARES)
        + " FROM o_clean"),
    "prepare_training": with_views("SELECT * FROM o_training"),
    "encode_dictionary": with_views(DICTIONARY),
    "encode_fit": with_views(f"SELECT id, year, {codes({c: c for c in CODED})} FROM o_clean"),
    "encode_apply": with_views(f"SELECT id, year, {codes({c: c for c in CODED})} FROM o_clean"),
    "encode_unknown_detect": with_views(UNKNOWN),
    "target_transform_log1p": with_views(
        "SELECT id, year, ROUND(LN(1 + n2o), 6) AS n2o_t, ROUND(LN(1 + no3), 6) AS no3_t, "
        "ROUND(LN(1 + yield_dm), 6) AS yield_t FROM o_targets"),
    "yeo_johnson_apply": with_views(
        f"SELECT id, year, ROUND(CASE WHEN soc >= 0 THEN {_pos} ELSE {_neg} END, 6) AS soc_t FROM o_targets"),
    "target_inverse": with_views(
        "SELECT id, year, ROUND(n2o, 5) AS n2o, ROUND(no3, 5) AS no3, "
        'ROUND(yield_dm, 5) AS "yield", ROUND(soc, 5) AS soc FROM o_targets'),
    "yeo_johnson_fit": with_views(
        "SELECT CAST(SUM(n) AS BIGINT) AS n, ROUND(ANY_VALUE(lam), 4) AS lam, ROUND(SUM(n * y) / SUM(n), 3) AS mean, "
        "ROUND(SQRT(SUM(n * y * y) / SUM(n) - POWER(SUM(n * y) / SUM(n), 2)), 3) AS std FROM final", YJ_FIT),
    "group_kfold": with_views(
        "SELECT CAST(f AS INT) AS fold, loads[f] AS n_val, CAST(1 AS BIGINT) AS folds_per_group "
        "FROM given CROSS JOIN RANGE(1, 6) r(f)", GREEDY.format(rows="fx_outputs")),
    "group_kfold_hash": with_views(
        "SELECT COUNT(*) AS n, CAST(1 AS BIGINT) AS folds_per_group, CAST(1 AS INT) AS first_fold, "
        "CAST(5 AS INT) AS last_fold FROM fx_outputs"),
    "kfold": with_views(
        "SELECT CAST(f AS INT) AS fold, n - n // 5 - CASE WHEN f <= n % 5 THEN 1 ELSE 0 END AS n_train, "
        "n // 5 + CASE WHEN f <= n % 5 THEN 1 ELSE 0 END AS n_val "
        "FROM (SELECT COUNT(*) AS n FROM fx_outputs) CROSS JOIN RANGE(1, 6) r(f)"),
    "kfold_duplicates": with_views(
        "SELECT CAST(f AS INT) AS fold, n - n // 5 - CASE WHEN f <= n % 5 THEN 1 ELSE 0 END AS n_train, "
        "n // 5 + CASE WHEN f <= n % 5 THEN 1 ELSE 0 END AS n_val "
        "FROM (SELECT COUNT(*) AS n FROM fx_outputs) CROSS JOIN RANGE(1, 6) r(f)"),
    "fold_sizes": with_views(
        "SELECT CAST(id % 5 + 1 AS INT) AS fold, (SELECT COUNT(*) FROM fx_outputs) - COUNT(*) AS n_train, "
        "COUNT(*) AS n_val FROM fx_outputs GROUP BY 1"),
    "regression_metrics": with_views(f"SELECT target, fold, n, CAST(0 AS BIGINT) AS n_missing, {rounded(['rmse', 'mae', 'r2'])} FROM o_metrics"),
    "metrics_with_missing": with_views(
        "SELECT target, fold, COUNT(*) FILTER (known) AS n, COUNT(*) FILTER (NOT known) AS n_missing, "
        "ROUND(SQRT(AVG(e * e) FILTER (known)), 6) AS rmse, ROUND(AVG(ABS(e)) FILTER (known), 6) AS mae, "
        "ROUND(1 - SUM(e * e) FILTER (known) / (COUNT(*) FILTER (known) * VAR_POP(y) FILTER (known)), 6) AS r2 "
        "FROM (SELECT *, y_pred - y AS e, y % 7 <> 0 AND y % 11 <> 0 AS known FROM fx_predictions) GROUP BY target, fold"),
    "stopping_rounds": """
WITH curves AS (
  SELECT l_suppkey, l_quantity AS error,
         ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity) AS round FROM lineitem),
lows AS (SELECT *, MIN(error) OVER (PARTITION BY l_suppkey ORDER BY round) AS low FROM curves),
news AS (SELECT *, MAX(CASE WHEN error = low AND (prior IS NULL OR error < prior) THEN round END) OVER (PARTITION BY l_suppkey ORDER BY round) AS best
         FROM (SELECT *, LAG(low) OVER (PARTITION BY l_suppkey ORDER BY round) AS prior FROM lows)),
stops AS (SELECT l_suppkey, COALESCE(MIN(CASE WHEN round - best >= 9 THEN round END), MAX(round)) AS stopped_at FROM news GROUP BY l_suppkey)
SELECT n.l_suppkey, CAST(n.best AS INT) AS best_round, CAST(stopped_at AS INT) AS stopped_at
FROM news n JOIN stops s ON s.l_suppkey = n.l_suppkey AND n.round = s.stopped_at""",
    "cv_summary_file": with_views(
        "SELECT CAST(5 AS INT) AS n_splits, target, CAST(COUNT(*) AS INT) AS n_folds, "
        + listed(f"ROUND({f}({m}), 6) AS {p}_{m}" for p, f in (("mean", "AVG"), ("std", "STDDEV_POP")) for m in ("rmse", "mae", "r2"))
        + " FROM o_metrics GROUP BY target"),
    "run_log_parameters": with_views(
        "SELECT DISTINCT 'trees_cv_fold' || fold AS run_name, p.parameter, p.value FROM fx_predictions, "
        "(VALUES ('depth', '4'), ('step_size', '0.5')) p(parameter, value)"),
    "predictions_two_models": with_views(
        "SELECT m.model, fold, target, y, y_pred FROM fx_predictions, (VALUES ('first'), ('second')) m(model)"),
    "cv_summary": with_views(
        "SELECT target, COUNT(*) AS n_folds, "
        + listed(f"ROUND(AVG({m}), 6) AS mean_{m}, ROUND(STDDEV_POP({m}), 6) AS std_{m}" for m in ("rmse", "mae", "r2"))
        + " FROM o_metrics GROUP BY target"),
    "cv_report": with_views(REPORT),
    "cv_report_from_log": with_views(REPORT),
    "run_log_flatten": with_views(f"SELECT target, fold, {rounded(['rmse', 'mae', 'r2'])} FROM o_metrics"),
    "predictions_table": with_views("SELECT 'depthwise_v1' AS model, target, y, y_pred FROM fx_predictions"),
    "train_multi_target": with_views(
        "SELECT t.target, COUNT(*) AS n, COUNT(*) AS n_finite FROM o_training, "
        "(VALUES ('n2o'), ('no3'), ('yield'), ('soc')) t(target) GROUP BY t.target"),
    "cv_train": with_views(
        "SELECT t.target, CAST(f AS INT) AS fold, loads[f] AS n, loads[f] AS n_finite FROM given CROSS JOIN RANGE(1, 6) r(f), "
        "(VALUES ('n2o'), ('no3'), ('yield'), ('soc')) t(target)", GREEDY.format(rows="o_training")),
    "assemble_features": with_views(
        f"SELECT id, year, CAST({len(_features)} AS INT) AS width, "
        f"ROUND({' + '.join(f'COALESCE({c}, -1)' for c in _features)}, 3) AS total FROM o_training"),
    "csv_quarantine": with_views(
        "SELECT id, CAST(date AS VARCHAR) AS date, prec, CASE WHEN id % 41 = 7 THEN NULL ELSE tavg END AS tavg FROM fx_climate WHERE id % 37 <> 5"),
    "csv_rejected_rows": with_views(
        "SELECT id, CAST(date AS VARCHAR) AS date, CONCAT('about ', id) AS prec, 'prec (double)' AS reason FROM fx_climate WHERE id % 37 = 5"),
    "multi_file_union": with_views(
        "SELECT id, CAST(year AS BIGINT) AS year, CASE WHEN id % 3 <> 1 THEN n_org_amount END AS n_org_amount, "
        "CASE WHEN id % 3 <> 0 THEN soil END AS soil FROM fx_outputs"),
    "bucketed_join": with_views(
        "SELECT o.id, year, soil, climate_id, site_id FROM fx_outputs o JOIN fx_sims s ON s.event_id = o.id"),
    "run_log_compacted": with_views(
        f"SELECT experiment_name, target, fold, {rounded(['rmse', 'mae', 'r2'])} FROM o_metrics, (VALUES ('a'), ('b')) e(experiment_name)"),
    "train_stump": with_views("SELECT * FROM stump_leaves", STUMP),
    "score_saved_model": with_views(
        "SELECT t.target, COUNT(*) AS n, COUNT(*) AS n_finite, CAST(0 AS BIGINT) AS n_differing FROM o_training, "
        "(VALUES ('n2o'), ('no3'), ('yield'), ('soc')) t(target) WHERE id % 4 = 0 GROUP BY t.target"),
}
