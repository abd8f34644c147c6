"""SQL checks for the registered queries, over the given tables only."""

from __future__ import annotations

from fixtures.views_sql import with_views

OBS, GAP, PRED, LONG_TERM = 48, 0, 24, 336
# the cohort every later check starts from
COHORT = {"coh": f"SELECT * FROM fx_compat WHERE los >= {OBS + GAP} / 24.0 AND age >= 18"}
LOCATION = "CASE raw_loc WHEN 'error' THEN 'Death' WHEN 'view' THEN 'Home' WHEN 'click' THEN 'Other' WHEN 'purchase' THEN 'Rehabilitation' END"


def text_of(items: str, sep: str = ",") -> str:
    return f"coalesce(array_to_string([CAST(x AS VARCHAR) FOR x IN {items}], '{sep}'), '')"


# --- scans and cohort -------------------------------------------------------------------------------------------

SCAN = "SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value, props FROM events"

STAY_COLUMNS = """stay_id, hadm_id, patient_id, los, {age} AS age, epoch_us(intime) AS intime, outtime_min, dischtime_min,
       in_icu_mortality, hos_discharge_location"""

NORMAL_ANCHOR = with_views("fx_compat", select=f"SELECT {STAY_COLUMNS.format(age='age')} FROM fx_compat")

BORN = "make_date(CAST(1940 + patient_id % 60 AS INT), CAST(1 + patient_id % 12 AS INT), CAST(1 + patient_id % 28 AS INT))"
AGE_AT = f"""CAST(year(intime) - year({BORN}) -
       CASE WHEN strftime(intime, '%m%d') < strftime({BORN}, '%m%d') THEN 1 ELSE 0 END AS INTEGER)"""
NORMAL_BIRTH = with_views("fx_compat", select=f"SELECT {STAY_COLUMNS.format(age=AGE_AT)} FROM fx_compat")

NORMAL_CAPPED = with_views(
    "fx_compat",
    "fx_stays",
    select=f"""
SELECT c.stay_id, c.hadm_id, CAST(c.patient_id AS VARCHAR) AS patient_id, CAST(c.outtime_min AS DOUBLE) / 60 / 24 AS los,
       CAST(CASE WHEN c.patient_id % 100 >= 90 THEN 300 ELSE c.patient_id % 100 END AS INTEGER) AS age,
       CAST(0 AS BIGINT) AS intime, c.outtime_min, c.dischtime_min, c.last_unit = 'error' AS in_icu_mortality,
       {LOCATION} AS hos_discharge_location
FROM fx_compat c JOIN fx_stays s USING (stay_id) WHERE c.patient_id % 100 > 0""",
)

SELECT_COHORT = with_views(
    "fx_compat",
    select="""
SELECT stay_id, hadm_id, los, age FROM fx_compat
WHERE los >= 2.0 AND age BETWEEN 18 AND 80 AND first_unit = last_unit""",
)

READMISSION_SELECT = """
SELECT stay_id, hadm_id,
       CASE WHEN row_number() OVER (PARTITION BY hadm_id ORDER BY intime DESC, stay_id) = 1 THEN 0 ELSE 1 END AS readmission
FROM coh"""
READMISSION = with_views("fx_compat", extra=COHORT, select=READMISSION_SELECT)

FIRST_STAY = with_views(
    "fx_compat",
    extra=COHORT,
    select="""
SELECT stay_id, hadm_id, epoch_us(intime) AS intime FROM coh
QUALIFY row_number() OVER (PARTITION BY hadm_id ORDER BY intime, stay_id) = 1""",
)

# --- outcome labels ---------------------------------------------------------------------------------------------


def dies_within(hours: int, out: str, dead: str = "hos_discharge_location = 'Death'") -> str:
    return with_views(
        "fx_compat",
        extra=COHORT,
        select=f"""
SELECT stay_id, CAST(coalesce(({dead}) AND dischtime_min > {(OBS + GAP) * 60}
                              AND dischtime_min <= {(OBS + hours) * 60}, false) AS INTEGER) AS {out} FROM coh""",
    )


LOS = with_views(
    "fx_compat",
    select="SELECT stay_id, CAST(los > 1 AS INTEGER) AS los_1day, CAST(los > 2 AS INTEGER) AS los_2day FROM fx_compat",
)

CLASSED = """
SELECT t.stay_id, CAST(coalesce(k.i, -1) AS INTEGER) AS {out}
FROM texts t LEFT JOIN (SELECT name, row_number() OVER (ORDER BY name) - 1 AS i
                        FROM (SELECT DISTINCT name FROM texts WHERE name IS NOT NULL)) k USING (name)"""

ACUITY_TEXT = """SELECT stay_id, CASE WHEN in_icu_mortality THEN 'IN_ICU_MORTALITY'
       WHEN hos_discharge_location = 'Death' THEN 'IN_HOSPITAL_MORTALITY' ELSE hos_discharge_location END AS name FROM coh"""
ACUITY = with_views("fx_compat", extra=COHORT | {"texts": ACUITY_TEXT}, select=CLASSED.format(out="final_acuity"))

DISCHARGE_TEXT = f"""SELECT stay_id, CASE WHEN coalesce(dischtime_min BETWEEN {(OBS + GAP) * 60} AND {(OBS + PRED) * 60}, false)
       THEN CASE WHEN in_icu_mortality OR hos_discharge_location = 'Death' THEN 'Death' ELSE hos_discharge_location END
       ELSE 'No Discharge' END AS name FROM coh"""
DISCHARGE = with_views("fx_compat", extra=COHORT | {"texts": DISCHARGE_TEXT}, select=CLASSED.format(out="imminent_discharge"))

CLASSES = with_views(
    "fx_compat",
    select="""
SELECT CAST(coalesce(k.i, -1) AS INTEGER) AS index, k.name, count(*) AS stays
FROM fx_compat c LEFT JOIN (SELECT name, row_number() OVER (ORDER BY name) - 1 AS i FROM (
       SELECT DISTINCT hos_discharge_location AS name FROM fx_compat WHERE hos_discharge_location IS NOT NULL)) k
  ON c.hos_discharge_location = k.name
GROUP BY ALL""",
)

# --- diagnosis codes --------------------------------------------------------------------------------------------

TENS = {"tens": "SELECT DISTINCT icd_code AS code FROM fx_dx WHERE icd_version = 10"}
CROSSWALK = with_views(
    "fx_dx",
    "fx_gem_last",
    extra=TENS,
    select="SELECT t.code, g.target AS converted FROM tens t LEFT JOIN fx_gem_last g ON g.source = t.code",
)
BACKOFF = with_views(
    "fx_dx",
    "fx_gem_last",
    extra=TENS
    | {
        "missing": "SELECT code FROM tens ANTI JOIN fx_gem_last ON source = code",
        "stem": """SELECT code, arg_max(prefix, length(prefix)) AS prefix
FROM (SELECT code, unnest([left(code, CAST(i AS INT)) FOR i IN range(1, length(code) + 1)]) AS prefix FROM missing)
SEMI JOIN fx_gem_last ON source = prefix GROUP BY code""",
        "gem_stem": "SELECT unnest([left(source, CAST(i AS INT)) FOR i IN range(1, length(source) + 1)]) AS prefix, target FROM fx_gem",
        "votes": "SELECT prefix, target, count(*) AS n FROM gem_stem SEMI JOIN stem USING (prefix) GROUP BY ALL",
        "best": "SELECT prefix, target FROM votes QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY n DESC, target) = 1",
    },
    select="""
SELECT t.code, coalesce(g.target, b.target) AS converted
FROM tens t LEFT JOIN fx_gem_last g ON g.source = t.code LEFT JOIN stem s ON s.code = t.code LEFT JOIN best b ON b.prefix = s.prefix""",
)
CONVERTED = """
SELECT hadm_id, CAST(icd_version AS INTEGER) AS icd_version, icd_code, CASE WHEN icd_version = 9 THEN icd_code ELSE target END AS converted
FROM fx_dx LEFT JOIN fx_gem_last ON source = icd_code AND icd_version = 10"""
CONVERT = with_views("fx_dx", "fx_gem_last", select=CONVERTED)


def code_set(rare: int, join: str) -> str:
    return with_views(
        "fx_dx",
        "fx_gem_last",
        "fx_ccs",
        extra={
            "conv": CONVERTED,
            "classes": f"""SELECT hadm_id, list_sort(list(DISTINCT CASE WHEN category > {rare} THEN category - 1 ELSE category END)) AS ks
FROM conv JOIN fx_ccs ON code = converted WHERE category <> {rare} GROUP BY hadm_id""",
        },
        select=f"""
SELECT c_custkey AS hadm_id, CASE WHEN ks IS NULL THEN '' ELSE {text_of('ks')} END AS diagnosis
FROM customer {join} JOIN classes ON hadm_id = c_custkey""",
    )


PATH_CODES = with_views("fx_path_codes", select="SELECT path, pos, code FROM fx_path_codes")

PATH_CATEGORIES = with_views(
    "fx_path_codes",
    extra={
        "known": "SELECT DISTINCT CAST(code AS INT) AS n FROM fx_path_codes WHERE CAST(code AS INT) <= 250",
        "found": """SELECT path, pos, known.n // 10 % 18 AS category
FROM fx_path_codes LEFT JOIN known ON n = CASE WHEN CAST(code AS INT) > 250 THEN CAST(code AS INT) - 250 ELSE CAST(code AS INT) END"""
    },
    select="""
SELECT path, CAST(arg_max(category, pos) AS INTEGER) AS category, min(category) <> max(category) AS conflict
FROM found WHERE category IS NOT NULL GROUP BY path""",
)

# every path has three segments, so the levels below the root are written out
VOTE = with_views(
    "fx_path_tags",
    extra={
        "two": """SELECT node, tag FROM (
  SELECT split_part(path, '|', 1) || '|' || split_part(path, '|', 2) AS node, tag, count(*) AS n, min(path) AS first
  FROM fx_path_tags GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY node ORDER BY n DESC, first) = 1""",
    },
    select="""
SELECT p.path, two.tag FROM (SELECT DISTINCT path FROM fx_paths ANTI JOIN fx_path_tags USING (path)) p
LEFT JOIN two ON two.node = split_part(p.path, '|', 1) || '|' || split_part(p.path, '|', 2)""",
)

# --- measurements and exclusions ---------------------------------------------------------------------------------

RISING = "CASE WHEN {v} < 15 THEN 0 WHEN {v} < 30 THEN 1 WHEN {v} < 60 THEN 2 WHEN {v} < 120 THEN 3 WHEN {v} >= 120 THEN 4 END"
FALLING = "CASE WHEN {v} >= 100 THEN 0 WHEN {v} >= 60 THEN 1 WHEN {v} >= 30 THEN 2 WHEN {v} >= 10 THEN 3 WHEN {v} < 10 THEN 4 END"
BANDED = "CASE WHEN {v} < 20 THEN 0 WHEN {v} <= 80 THEN 1 WHEN {v} > 80 THEN 2 END"
MINUTE = "round((epoch_us({t}) // 1000000 - epoch_us(intime) // 1000000) / 60.0)"
MEASURED_STEPS = {
    "inside": f"""SELECT c.stay_id, l.itemid, l.valuenum, e.first_excl IS NULL OR e.first_excl > l.charttime AS clean
FROM coh c JOIN fx_labs l USING (hadm_id) LEFT JOIN fx_excl e ON e.patient_id = c.patient_id
WHERE {MINUTE.format(t='charttime')} BETWEEN {(OBS + GAP) * 60} AND {(OBS + PRED) * 60}""",
    "means": """SELECT stay_id, avg(valuenum) FILTER (itemid = 'purchase') AS a, avg(valuenum) FILTER (itemid = 'view') AS b,
       avg(valuenum) FILTER (itemid = 'click') AS c, avg(valuenum) FILTER (itemid = 'signup' AND clean) AS d
FROM inside GROUP BY stay_id""",
}
MEASURED = with_views(
    "fx_compat",
    "fx_labs",
    "fx_excl",
    extra=COHORT | MEASURED_STEPS,
    select=f"""
SELECT stay_id, {RISING.format(v='a')} AS rising, {FALLING.format(v='b')} AS falling, {BANDED.format(v='c')} AS banded,
       {RISING.format(v='d')} AS untreated
FROM coh LEFT JOIN means USING (stay_id)""",
)

FIRST_EXCL = with_views(
    "fx_raw",
    select="""
SELECT e.patient_id, epoch_us(min(e.ts)) AS first_excl FROM fx_ev e JOIN fx_raw r USING (stay_id)
WHERE (e.event_type = 'error' AND e.value > 200) OR (e.event_type = 'purchase' AND e.value > 300 AND r.first_type = 'view')
GROUP BY e.patient_id""",
)
BEFORE_EXCL = with_views(
    "fx_labs",
    "fx_excl",
    select="""
SELECT event_id, stay_id FROM fx_labs LEFT JOIN fx_excl USING (patient_id) WHERE first_excl IS NULL OR first_excl > charttime""",
)
MULTI_STAY = with_views(
    "fx_labs",
    "fx_compat",
    select="""
SELECT event_id, patient_id FROM fx_labs WHERE patient_id NOT IN (
  SELECT patient_id FROM fx_ev WHERE event_type = 'error' AND value > 200
  INTERSECT SELECT patient_id FROM fx_compat GROUP BY patient_id HAVING count(*) > 1)""",
)

# --- events -----------------------------------------------------------------------------------------------------

BY_STAY = with_views(
    "fx_ev",
    "fx_compat",
    extra=COHORT,
    select="""
SELECT event_id, stay_id, epoch_us(ts) AS ts, epoch_us(intime) AS intime, outtime_min FROM fx_ev JOIN coh USING (stay_id)""",
)
STAR_JOIN = f"""
SELECT hadm_id, stay_id, charttime, intime, itemid, l_quantity, CAST({MINUTE.format(t='charttime')} AS INTEGER) AS time_min
FROM fx_star_ev JOIN fx_star_stays USING (hadm_id) WHERE {MINUTE.format(t='charttime')} BETWEEN 0 AND outtime_min"""
BY_ADMISSION = with_views(
    "fx_star_ev",
    "fx_star_stays",
    extra={"j": STAR_JOIN},
    select="SELECT hadm_id, stay_id, epoch_us(charttime) AS charttime, epoch_us(intime) AS intime, itemid, l_quantity FROM j",
)
SEEN = f"""SELECT event_id, stay_id, CAST({MINUTE.format(t='ts')} AS INTEGER) AS time_min, event_type, value
FROM fx_ev JOIN coh USING (stay_id) WHERE {MINUTE.format(t='ts')} BETWEEN 0 AND {OBS * 60}"""
WINDOW = with_views("fx_ev", "fx_compat", extra=COHORT, select=SEEN)
WINDOW_OFFSETS = with_views(
    "fx_ev",
    "fx_compat",
    extra=COHORT
    | {
        "o": """SELECT event_id, stay_id, CAST(floor((epoch_us(ts) - epoch_us(intime)) / CAST(60000000 AS DOUBLE)) AS INTEGER) - 60 AS m
FROM fx_ev JOIN coh USING (stay_id)"""
    },
    select=f"SELECT event_id, stay_id, CAST(m AS VARCHAR) AS offset_text, m AS time_min FROM o WHERE m BETWEEN 0 AND {OBS * 60}",
)
DESCRIBED = with_views(
    "fx_star_ev",
    "fx_part_text",
    select="""
SELECT hadm_id, epoch_us(charttime) AS charttime, text AS item, l_quantity FROM fx_star_ev LEFT JOIN fx_part_text ON code = itemid""",
)
UNITS = with_views(
    "fx_star_ev",
    "fx_part_text",
    select="""
SELECT hadm_id, epoch_us(charttime) AS charttime,
       concat_ws(';', '0:itemid:' || text, '1:l_quantity:' || CAST(l_quantity AS VARCHAR),
                 '2:l_extendedprice:' || CAST(l_extendedprice AS VARCHAR), '3:l_returnflag:' || l_returnflag) AS units
FROM fx_star_ev LEFT JOIN fx_part_text ON code = itemid""",
)
UNION = with_views(
    "fx_ev",
    "fx_compat",
    "fx_star_ev",
    "fx_star_stays",
    extra=COHORT | {"seen": SEEN, "j": STAR_JOIN},
    select=f"""
SELECT stay_id, time_min, event_id AS row_key, 0 AS table_no FROM seen
UNION ALL SELECT stay_id, time_min, itemid, 1 FROM j WHERE time_min <= {OBS * 60}""",
)

# --- text -------------------------------------------------------------------------------------------------------

# one decimal per text in this view: digits, a dot, digits
ROUNDED = """CAST(regexp_extract({t}, '[0-9]*[.][0-9]+') AS DECIMAL(38, 6))"""
ROUND = with_views(
    "fx_text",
    extra={"r": f"SELECT *, CAST(round({ROUNDED.format(t='text')}, 4) AS DECIMAL(38, 4)) AS x FROM fx_text"},
    select="""
SELECT l_orderkey, l_linenumber, l_partkey,
       regexp_replace(text, '[0-9]*[.][0-9]+', regexp_replace(CAST(x AS VARCHAR), '([.][0-9]+?)0+$', '\\1')) AS text FROM r""",
)
SPACE = with_views(
    "fx_text",
    select="SELECT l_orderkey, l_linenumber, l_partkey, regexp_replace(text, '([0-9.])', ' \\1 ', 'g') AS text FROM fx_text",
)
PLACES = """
WITH g AS (SELECT event_id, regexp_extract_all(CAST(value AS VARCHAR), '[0-9]+(?:[.][0-9]*)?|[.]+') AS groups FROM events)
SELECT event_id, coalesce(array_to_string([CAST(p AS VARCHAR) FOR p IN flatten([
         CASE WHEN x[1] = '.' THEN [0 FOR i IN range(length(x))]
              ELSE [5 + (CASE WHEN instr(x, '.') > 0 THEN instr(x, '.') - 1 ELSE length(x) END) - i FOR i IN range(length(x))] END
         FOR x IN groups])], ','), '') AS places FROM g"""


# greedy longest match: best end per start, then the chain of ends from the first character
def pieces_of(words: str) -> dict[str, str]:
    return {
        "missed": f"SELECT DISTINCT word FROM ({words}) ANTI JOIN fx_vocab ON token = word",
        "spans": """SELECT word, CAST(a.i AS INTEGER) AS first, CAST(b.i AS INTEGER) AS last
FROM missed, unnest(range(1, length(word) + 1)) a(i), unnest(range(a.i, length(word) + 1)) b(i)""",
        "best": """SELECT word, first, max(last) AS last, arg_max(id, last) AS id
FROM spans JOIN fx_vocab ON token = CASE WHEN first > 1 THEN '##' ELSE '' END || substr(word, first, last - first + 1)
GROUP BY word, first""",
        "walk": """SELECT word, 1 AS next, CAST([] AS INTEGER[]) AS ids FROM missed
UNION ALL SELECT w.word, b.last + 1, list_append(w.ids, b.id) FROM walk w JOIN best b ON b.word = w.word AND b.first = w.next""",
        "known": f"""SELECT word, ids FROM walk WHERE next = length(word) + 1
UNION ALL SELECT DISTINCT word, [id] FROM ({words}) JOIN fx_vocab ON token = word""",
    }


PUNCTUATION = r"[:punct:]\p{P}"
IDEOGRAPHS = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}"
    r"\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)
WORD = rf"[{PUNCTUATION}{IDEOGRAPHS}]|[^{PUNCTUATION}{IDEOGRAPHS}\s\x0B\p{{Z}}]+"
REMOVED = r"[\x{0}-\x{8}\x{B}\x{C}\x{E}-\x{1F}\x{7F}-\x{9F}\x{FFFD}\p{Cf}]"
DOC_WORDS = {
    "lists": f"SELECT doc_id, regexp_extract_all(regexp_replace(lower(text), '{REMOVED}', '', 'g'), '{WORD}') AS ws FROM documents",
    "words": "SELECT doc_id, pos, ws[pos] AS word FROM lists, unnest(range(1, len(ws) + 1)) u(pos)",
}
WORD_PIECES = with_views(
    "fx_vocab",
    extra=DOC_WORDS | pieces_of("SELECT word FROM words"),
    recursive=True,
    select=f"""
SELECT doc_id, coalesce(ids, '') AS ids FROM documents LEFT JOIN (
  SELECT doc_id, {text_of('flatten(list(coalesce(ids, [100]) ORDER BY pos))')} AS ids
  FROM words LEFT JOIN known USING (word) GROUP BY doc_id) t USING (doc_id)""",
)

# texts of this view: letters, blanks, numbers with one dot at most
TEXT_WORDS = {
    "rounded": f"""SELECT DISTINCT text, regexp_replace(text, '[0-9]*[.][0-9]+', regexp_replace(CAST(
       CAST(round({ROUNDED.format(t='text')}, 4) AS DECIMAL(38, 4)) AS VARCHAR), '([.][0-9]+?)0+$', '\\1')) AS plain FROM fx_text""",
    "segments": "SELECT text, regexp_extract_all(lower(plain), '[0-9]+(?:[.][0-9]*)?|[a-z]+') AS segs FROM rounded",
    "words": """SELECT text, k, p, CASE WHEN seg[1] < 'a' THEN seg[p] ELSE seg END AS word,
       CASE WHEN seg[1] < 'a' THEN 6 + (CASE WHEN instr(seg, '.') > 0 THEN instr(seg, '.') - 1 ELSE length(seg) END) - p ELSE 0 END AS place
FROM (SELECT text, k, segs[k] AS seg FROM segments, unnest(range(1, len(segs) + 1)) u(k)),
     unnest(range(1, CASE WHEN seg[1] < 'a' THEN length(seg) + 1 ELSE 2 END)) c(p)""",
}
ENCODED_TEXTS = with_views(
    "fx_text",
    "fx_vocab",
    extra=TEXT_WORDS | pieces_of("SELECT word FROM words"),
    recursive=True,
    select=f"""
SELECT text, {text_of('flatten(list(coalesce(ids, [100]) ORDER BY k, p))')} AS ids,
       {text_of('flatten(list([place FOR i IN coalesce(ids, [100])] ORDER BY k, p))')} AS dpes
FROM words LEFT JOIN known USING (word) GROUP BY text""",
)

# events as (table name, then column and value units): words first, then the running length decides what stays
EVENT_UNITS = {
    "texts": """SELECT event_id, stay_id, -1 AS pos, 1 AS type, 'events' AS text FROM fx_ev
UNION ALL SELECT event_id, stay_id, 0, 2, 'event_type' FROM fx_ev WHERE event_type IS NOT NULL
UNION ALL SELECT event_id, stay_id, 0, 3, event_type FROM fx_ev WHERE event_type IS NOT NULL
UNION ALL SELECT event_id, stay_id, 1, 2, 'value' FROM fx_ev WHERE value IS NOT NULL
UNION ALL SELECT event_id, stay_id, 1, 3, CAST(value AS VARCHAR) FROM fx_ev WHERE value IS NOT NULL
UNION ALL SELECT event_id, stay_id, 2, 2, 'props' FROM fx_ev WHERE props IS NOT NULL
UNION ALL SELECT event_id, stay_id, 2, 3, props FROM fx_ev WHERE props IS NOT NULL""",
    "segments": rf"SELECT DISTINCT text, regexp_extract_all(lower(text), '[0-9]+(?:[.][0-9]*)?|[a-z]+|[{PUNCTUATION}]') AS segs FROM texts",
    "words": """SELECT text, k, p, CASE WHEN seg[1] BETWEEN '0' AND '9' THEN seg[p] ELSE seg END AS word,
       CASE WHEN seg[1] BETWEEN '0' AND '9'
            THEN 6 + (CASE WHEN instr(seg, '.') > 0 THEN instr(seg, '.') - 1 ELSE length(seg) END) - p ELSE 0 END AS place
FROM (SELECT text, k, segs[k] AS seg FROM segments, unnest(range(1, len(segs) + 1)) u(k)),
     unnest(range(1, CASE WHEN seg[1] BETWEEN '0' AND '9' THEN length(seg) + 1 ELSE 2 END)) c(p)""",
}
ENCODED_EVENTS = with_views(
    "fx_ev",
    "fx_vocab",
    extra=EVENT_UNITS
    | pieces_of("SELECT word FROM words")
    | {
        "coded": """SELECT text, flatten(list(coalesce(ids, [100]) ORDER BY k, p)) AS ids,
       flatten(list([place FOR i IN coalesce(ids, [100])] ORDER BY k, p)) AS dpes
FROM words LEFT JOIN known USING (word) GROUP BY text""",
        "sized": "SELECT event_id, stay_id, pos, sum(len(ids)) AS n FROM texts JOIN coded USING (text) GROUP BY ALL",
        "running": "SELECT *, sum(n) OVER (PARTITION BY event_id ORDER BY pos) AS used FROM sized",
        "kept": "SELECT event_id, pos FROM running WHERE pos = -1 OR used + 2 <= 32",
    },
    recursive=True,
    select=f"""
SELECT event_id, stay_id, {text_of('flatten(list(ids ORDER BY pos, type))')} AS ids,
       {text_of('flatten(list([type FOR i IN ids] ORDER BY pos, type))')} AS types,
       {text_of('flatten(list(dpes ORDER BY pos, type))')} AS dpes
FROM texts JOIN coded USING (text) SEMI JOIN kept USING (event_id, pos) GROUP BY event_id, stay_id""",
)

# --- history and packing ----------------------------------------------------------------------------------------

MAX_TOKENS, MAX_EVENTS, MIN_EVENTS, EVENT_TOKENS = 24, 5, 2, 10


def cut(max_tokens: int = MAX_TOKENS, max_events: int = MAX_EVENTS) -> dict[str, str]:
    return {
        "numbered": """SELECT *, row_number() OVER w AS event_no, sum(len(ids) + 1) OVER w AS used
FROM fx_tokens WINDOW w AS (PARTITION BY stay_id ORDER BY time_min DESC, event_id DESC)""",
        "kept": f"""SELECT * FROM numbered WHERE event_no <= {max_events} AND used <= {max_tokens - 1}
QUALIFY count(*) OVER (PARTITION BY stay_id) > {MIN_EVENTS}""",
    }


CUT_SELECT = "SELECT stay_id, event_id, time_min, CAST(event_no AS INTEGER) AS event_no FROM kept"
CUT = with_views("fx_tokens", extra=cut(), select=CUT_SELECT)
CUT_UNLIMITED = with_views("fx_tokens", extra=cut(2000, 1999), select=CUT_SELECT)


def padded(items: str, length: int) -> str:
    return f"list_concat({items}, [0 FOR i IN range({length} - len({items}))])"


def marked(col: str, start: int, end: int) -> str:
    return f"list_concat([{start}], {col}, [{end}])"


EVENT_HI = "list_concat({}, {}, {})".format(
    padded(marked("ids", 101, 102), EVENT_TOKENS),
    padded(marked("types", 5, 6), EVENT_TOKENS),
    padded(marked("dpes", 0, 0), EVENT_TOKENS),
)
HIERARCHICAL = with_views(
    "fx_tokens",
    extra=cut() | {"e": f"SELECT stay_id, event_no, time_min, {EVENT_HI} AS event FROM kept"},
    select=f"""
SELECT stay_id, {text_of('flatten(list(event ORDER BY event_no DESC))')} AS hi, {text_of('list(time_min ORDER BY event_no DESC)')} AS time
FROM e GROUP BY stay_id""",
)
FLAT_STEPS = {
    "chains": """SELECT stay_id, list_concat([101], flatten(list(list_append(ids, 102) ORDER BY event_no DESC))) AS a,
       list_concat([5], flatten(list(list_append(types, 6) ORDER BY event_no DESC))) AS b,
       list_concat([0], flatten(list(list_append(dpes, 0) ORDER BY event_no DESC))) AS c, count(*) AS events
FROM kept GROUP BY stay_id""",
    "flat": f"""SELECT stay_id, events, {padded('a', MAX_TOKENS)} AS a, {padded('b', MAX_TOKENS)} AS b, {padded('c', MAX_TOKENS)} AS c
FROM chains""",
}
FLAT = with_views("fx_tokens", extra=cut() | FLAT_STEPS, select=f"SELECT stay_id, {text_of('list_concat(a, b, c)')} AS fl FROM flat")

# --- data set ---------------------------------------------------------------------------------------------------


def split_steps(source: str) -> dict[str, str]:
    return {
        "drawn": f"""SELECT patient_id, seed, count(*) AS n FROM {source}, (VALUES (42), (7)) s(seed) GROUP BY ALL""",
        "running": """SELECT patient_id, seed, sum(n) OVER (PARTITION BY seed) AS total,
       sum(n) OVER (PARTITION BY seed ORDER BY md5(patient_id || ':' || seed)) AS c FROM drawn""",
        "placed": """SELECT patient_id, seed, CASE WHEN c < floor(total * CAST(0.1 AS DOUBLE)) THEN 'test'
       WHEN c < floor(total * 2 * CAST(0.1 AS DOUBLE)) THEN 'valid' ELSE 'train' END AS split FROM running""",
        "wide": """SELECT patient_id, max(split) FILTER (seed = 42) AS split_42, max(split) FILTER (seed = 7) AS split_7
FROM placed GROUP BY patient_id""",
    }


SPLIT = with_views(
    "fx_compat",
    extra=COHORT | split_steps("coh"),
    select="SELECT stay_id, patient_id, split_42, split_7 FROM coh JOIN wide USING (patient_id)",
)
ACTIVE = with_views(
    "fx_tokens", extra=COHORT | cut(), select="SELECT stay_id, patient_id FROM coh SEMI JOIN kept USING (stay_id)"
)
SKIPPED = with_views(
    "fx_tokens",
    extra=COHORT | cut(),
    select="""
SELECT count(*) AS stays, count(k.stay_id) AS active, count(*) - count(k.stay_id) AS skipped
FROM coh LEFT JOIN (SELECT DISTINCT stay_id FROM kept) k USING (stay_id)""",
)
ACTIVE_STEPS = COHORT | cut() | FLAT_STEPS | {"texts": ACUITY_TEXT, "active": "SELECT * FROM coh SEMI JOIN kept USING (stay_id)"}
WRITTEN = with_views(
    "fx_tokens",
    extra=ACTIVE_STEPS
    | split_steps("active")
    | {
        "hi_events": f"SELECT stay_id, event_no, {EVENT_HI} AS event FROM kept",
        "hi_lists": f"SELECT stay_id, {text_of('flatten(list(event ORDER BY event_no DESC))')} AS hi FROM hi_events GROUP BY stay_id",
    },
    select=f"""
SELECT a.stay_id, hi, {text_of('list_concat(f.a, f.b, f.c)')} AS fl,
       CAST(coalesce(hos_discharge_location = 'Death' AND dischtime_min > {(OBS + GAP) * 60}
                     AND dischtime_min <= {(OBS + PRED) * 60}, false) AS INTEGER) AS mortality,
       name, split_42, split_7
FROM active a JOIN flat f USING (stay_id) JOIN hi_lists USING (stay_id) JOIN texts USING (stay_id) JOIN wide USING (patient_id)""",
)
COHORT_FILE = with_views(
    "fx_tokens",
    extra=ACTIVE_STEPS | split_steps("active"),
    select=f"""
SELECT stay_id, active.patient_id, los,
       CAST(coalesce(hos_discharge_location = 'Death' AND dischtime_min > {(OBS + GAP) * 60}
                     AND dischtime_min <= {(OBS + PRED) * 60}, false) AS INTEGER) AS mortality,
       split_42, split_7, split_42 || ',' || split_7 AS splits
FROM active JOIN wide USING (patient_id)""",
)
STAGED = with_views(
    "fx_compat",
    extra=COHORT,
    select="""
SELECT stay_id, hadm_id, los, 'first' AS call FROM coh UNION ALL SELECT stay_id, hadm_id, los, 'again' FROM coh
UNION ALL SELECT stay_id, hadm_id, los, 'changed' FROM coh WHERE los >= 2.5""",
)
BUCKETED = with_views(
    "fx_compat",
    extra=COHORT,
    select="""
SELECT stay_id, hadm_id, los, 'before' AS state FROM coh WHERE stay_id % 100 <> 0 UNION ALL SELECT stay_id, hadm_id, los, 'after' FROM coh""",
)
CHECKED_FILE = """
SELECT CASE WHEN good THEN c_custkey END AS c_custkey, CASE WHEN good THEN c_name || ', again' END AS c_name, CASE WHEN good THEN c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 7 = 0 THEN c_custkey || ',"' || c_name || ', again",1,more' WHEN NOT good THEN CAST(c_custkey AS VARCHAR) END AS line
FROM (SELECT *, c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AS good FROM customer)"""
CSV_FILES = """
SELECT c_custkey, c_name, c_acctbal, 'plain' AS kind FROM customer UNION ALL SELECT c_custkey, c_name, c_acctbal, 'gz' FROM customer"""
CATEGORIES = with_views("fx_ccs", select="SELECT code, CAST(category AS INTEGER) AS category FROM fx_ccs")
CROSSWALK_FILE = with_views("fx_gem_last", select="SELECT source AS code, target FROM fx_gem_last")
DICTIONARY = with_views("fx_part_text", select="SELECT CAST(code AS VARCHAR) AS code, text FROM fx_part_text")

CHANNELS = f"""SELECT stay_id, event_no, {padded(marked('ids', 101, 102), EVENT_TOKENS)} AS i,
       {padded(marked('types', 5, 6), EVENT_TOKENS)} AS t, {padded(marked('dpes', 0, 0), EVENT_TOKENS)} AS p FROM kept"""
CLASS_OF = {"classed": CLASSED.format(out="label")}
HI_LISTS = {
    "events_hi": CHANNELS,
    "lists": """SELECT stay_id, flatten(list(i ORDER BY event_no DESC)) AS input_ids, flatten(list(t ORDER BY event_no DESC)) AS type_ids,
       flatten(list(p ORDER BY event_no DESC)) AS dpe_ids, count(*) AS length FROM events_hi GROUP BY stay_id""",
}
TRAINING = with_views(
    "fx_tokens",
    extra=ACTIVE_STEPS | split_steps("active") | CLASS_OF | HI_LISTS,
    select=f"""
SELECT a.stay_id, {text_of('input_ids')} AS input_ids, {text_of('type_ids')} AS type_ids, {text_of('dpe_ids')} AS dpe_ids, label
FROM active a JOIN lists USING (stay_id) JOIN classed USING (stay_id) JOIN wide USING (patient_id) WHERE split_42 = 'train'""",
)
TRAINING_FLAT = with_views(
    "fx_tokens",
    extra=ACTIVE_STEPS | split_steps("active"),
    select=f"""
SELECT a.stay_id, {text_of('f.a')} AS input_ids, {text_of('f.b')} AS type_ids, {text_of('f.c')} AS dpe_ids,
       CAST(coalesce(hos_discharge_location = 'Death' AND dischtime_min > {(OBS + GAP) * 60}
                     AND dischtime_min <= {(OBS + PRED) * 60}, false) AS INTEGER) AS label
FROM active a JOIN flat f USING (stay_id) JOIN wide USING (patient_id) WHERE split_7 = 'valid'""",
)
CLASS_COUNTS = with_views(
    "fx_compat",
    extra=COHORT | {"texts": ACUITY_TEXT},
    select="""
SELECT 'final_acuity' AS target, CAST(count(DISTINCT name) AS INTEGER) AS classes FROM texts UNION ALL SELECT 'mortality', 2 UNION ALL SELECT 'diagnosis', 17""",
)
BATCHES = with_views(
    "fx_tokens",
    extra=ACTIVE_STEPS
    | CLASS_OF
    | HI_LISTS
    | {
        "numbered_stays": """SELECT stay_id, input_ids, type_ids, dpe_ids, length, label,
       (row_number() OVER (ORDER BY md5(stay_id || ':0')) - 1) // 32 AS batch
FROM active JOIN lists USING (stay_id) JOIN classed USING (stay_id)""",
        "longest": "SELECT *, max(length) OVER (PARTITION BY batch) AS n FROM numbered_stays",
    },
    select=f"""
SELECT CAST(batch AS BIGINT) AS batch, stay_id, CAST(n AS INTEGER) AS length,
       {", ".join(text_of(f'list_concat({c}, [0 FOR i IN range({EVENT_TOKENS} * (n - length))])') + f" AS {c}" for c in ("input_ids", "type_ids", "dpe_ids"))},
       {text_of('[CASE WHEN i = label THEN 1 ELSE 0 END FOR i IN range(6)]')} AS label
FROM longest""",
)


# --- whole run --------------------------------------------------------------------------------------------------

MONTH, HALF_MONTH, EPOCH = 2592000, 1296000, 1704067200
RUN_TOKENS, RUN_EVENTS, RUN_EVENT_TOKENS = 512, 64, 32


def unit_texts(table_no: int, table: str, columns: dict[str, str]) -> str:
    rows = [f"SELECT eid, -1 AS pos, 1 AS type, '{table}' AS text FROM latest WHERE table_no = {table_no}"]
    for pos, (name, value) in enumerate(columns.items()):
        at = f"FROM latest WHERE table_no = {table_no} AND {value} IS NOT NULL"
        rows += [f"SELECT eid, {pos}, 2, '{name}' {at}", f"SELECT eid, {pos}, 3, CAST({value} AS VARCHAR) {at}"]
    return "\nUNION ALL ".join(rows)


OBSERVED = f"""
SELECT stay_id, CAST({MINUTE.format(t='ts')} AS INTEGER) AS time_min, 0 AS table_no, event_id AS row_key,
       event_type AS a, value AS b, props AS c,
       CAST(NULL AS VARCHAR) AS item, CAST(NULL AS DOUBLE) AS quantity, CAST(NULL AS DOUBLE) AS price, CAST(NULL AS VARCHAR) AS flag
FROM fx_ev JOIN coh USING (stay_id) WHERE {MINUTE.format(t='ts')} BETWEEN 0 AND {OBS * 60}
UNION ALL
SELECT stay_id, CAST(round((second - epoch_us(intime) // 1000000) / 60.0) AS INTEGER), 1, line_id, NULL, NULL, NULL, text, l_quantity, l_extendedprice, l_returnflag
FROM (SELECT *, {EPOCH} + (epoch_us(charttime) // 1000000) % {MONTH} AS second FROM fx_star_ev) s
JOIN coh ON coh.hadm_id = s.hadm_id * 10 + (second - {EPOCH}) // {HALF_MONTH} LEFT JOIN fx_part_text ON code = itemid
WHERE round((second - epoch_us(intime) // 1000000) / 60.0) BETWEEN 0 AND least(outtime_min, {OBS * 60})"""

RUN_STEPS = {
    "observed": OBSERVED,
    "latest": f"""SELECT *, row_number() OVER () AS eid FROM (
  SELECT *, row_number() OVER (PARTITION BY stay_id ORDER BY time_min DESC, table_no DESC, row_key DESC) AS event_no FROM observed)
WHERE event_no <= {RUN_EVENTS}""",
    "texts": unit_texts(0, "events", {"event_type": "a", "value": "b", "props": "c"})
    + "\nUNION ALL "
    + unit_texts(1, "orders", {"itemid": "item", "l_quantity": "quantity", "l_extendedprice": "price", "l_returnflag": "flag"}),
    "segments": EVENT_UNITS["segments"],
    "words": EVENT_UNITS["words"],
    **pieces_of("SELECT word FROM words"),
    "coded": """SELECT text, flatten(list(coalesce(ids, [100]) ORDER BY k, p)) AS ids,
       flatten(list([place FOR i IN coalesce(ids, [100])] ORDER BY k, p)) AS dpes
FROM words LEFT JOIN known USING (word) GROUP BY text""",
    "running_units": "SELECT eid, pos, sum(sum(len(ids))) OVER (PARTITION BY eid ORDER BY pos) AS used FROM texts JOIN coded USING (text) GROUP BY eid, pos",
    "units": f"SELECT eid, pos FROM running_units WHERE pos = -1 OR used + 2 <= {RUN_EVENT_TOKENS}",
    "encoded": """SELECT eid, flatten(list(ids ORDER BY pos, type)) AS ids, flatten(list([type FOR i IN ids] ORDER BY pos, type)) AS types,
       flatten(list(dpes ORDER BY pos, type)) AS dpes
FROM texts JOIN coded USING (text) SEMI JOIN units USING (eid, pos) GROUP BY eid""",
    "filled": """SELECT stay_id, time_min, event_no, ids, types, dpes, sum(len(ids) + 1) OVER (PARTITION BY stay_id ORDER BY event_no) AS used
FROM latest JOIN encoded USING (eid)""",
    "kept": f"SELECT * FROM filled WHERE used <= {RUN_TOKENS - 1} QUALIFY count(*) OVER (PARTITION BY stay_id) > {MIN_EVENTS}",
    "chains": FLAT_STEPS["chains"],
    "times": "SELECT stay_id, list(time_min ORDER BY event_no DESC) AS time FROM kept GROUP BY stay_id",
    "active": "SELECT * FROM coh SEMI JOIN kept USING (stay_id)",
    **split_steps("active"),
}


def coded_class(name: str, texts: str) -> dict[str, str]:
    return {f"{name}_texts": texts, f"{name}_codes": CLASSED.format(out=name).replace("texts", f"{name}_texts")}


def dies(hours: int) -> str:
    return f"""CAST(coalesce(hos_discharge_location = 'Death' AND dischtime_min > {(OBS + GAP) * 60}
                     AND dischtime_min <= {(OBS + hours) * 60}, false) AS INTEGER)"""


WHOLE = with_views(
    "fx_compat",
    "fx_labs",
    "fx_excl",
    "fx_star_ev",
    "fx_part_text",
    "fx_vocab",
    "fx_dx",
    "fx_gem_last",
    "fx_ccs",
    extra=COHORT
    | {
        "conv": CONVERTED,
        "classes": """SELECT hadm_id * 10 + icd_version % 2 AS hadm_id, list_sort(list(DISTINCT CASE WHEN category > 14 THEN category - 1 ELSE category END)) AS ks
FROM conv JOIN fx_ccs ON code = converted WHERE category <> 14 GROUP BY ALL""",
    }
    | MEASURED_STEPS
    | coded_class("final_acuity", ACUITY_TEXT)
    | coded_class("imminent_discharge", DISCHARGE_TEXT)
    | {"seen_stays": READMISSION_SELECT}
    | RUN_STEPS,
    recursive=True,
    select=f"""
SELECT a.stay_id, a.patient_id, readmission, {dies(PRED)} AS mortality, {dies(LONG_TERM)} AS long_term_mortality,
       CAST(los > 3 AS INTEGER) AS los_3day, CAST(los > 7 AS INTEGER) AS los_7day, final_acuity, imminent_discharge,
       CASE WHEN ks IS NULL THEN '' ELSE {text_of('ks')} END AS diagnosis,
       {RISING.format(v='m.a')} AS rising, {FALLING.format(v='m.b')} AS falling, {BANDED.format(v='m.c')} AS banded,
       {RISING.format(v='m.d')} AS untreated, split_42, split_7, CAST(events AS INTEGER) AS events,
       {text_of(padded('f.a', RUN_TOKENS))} AS ids, {text_of(padded('f.b', RUN_TOKENS))} AS types,
       {text_of(padded('f.c', RUN_TOKENS))} AS dpes, {text_of('time')} AS time
FROM active a JOIN seen_stays USING (stay_id) JOIN final_acuity_codes USING (stay_id) JOIN imminent_discharge_codes USING (stay_id)
JOIN chains f USING (stay_id) JOIN times USING (stay_id) JOIN wide USING (patient_id) LEFT JOIN means m USING (stay_id)
LEFT JOIN classes ON classes.hadm_id = a.hadm_id""",
)


WHOLE_OFFSETS = with_views(
    "fx_compat",
    "fx_stays",
    "fx_raw",
    "fx_path_tags",
    "fx_vocab",
    extra={
        "coh": f"""
SELECT c.stay_id, c.hadm_id, CAST(c.patient_id AS VARCHAR) AS patient_id, CAST(c.outtime_min AS DOUBLE) / 60 / 24 AS los, c.dischtime_min,
       c.last_unit = 'error' AS in_icu_mortality, {LOCATION} AS hos_discharge_location
FROM fx_compat c JOIN fx_stays s USING (stay_id)
WHERE c.patient_id % 100 >= 18 AND CAST(c.outtime_min AS DOUBLE) / 60 / 24 >= {(OBS + GAP) / 24}""",
        "offsets": """
SELECT e.*, CAST(floor((epoch_us(e.ts) - epoch_us(r.intime)) / 60000000.0) AS INTEGER) AS offset_min FROM fx_ev e JOIN fx_raw r USING (stay_id)""",
        "excluded": "SELECT stay_id, min(offset_min) AS first_excl FROM offsets WHERE event_type = 'error' AND value > 200 GROUP BY stay_id",
        "dropped": """
SELECT CAST(patient_id AS VARCHAR) AS patient_id FROM fx_raw GROUP BY patient_id
HAVING count(*) > 1 AND count(*) FILTER (stay_id IN (SELECT stay_id FROM excluded)) > 0""",
        "inside": f"""
SELECT c.stay_id, o.event_type AS itemid, o.value AS valuenum, e.first_excl IS NULL OR e.first_excl > o.offset_min AS clean
FROM coh c JOIN offsets o USING (stay_id) LEFT JOIN excluded e USING (stay_id) WHERE offset_min BETWEEN {(OBS + GAP) * 60} AND {(OBS + PRED) * 60}""",
        "means": MEASURED_STEPS["means"],
        "two": """SELECT node, tag FROM (
  SELECT split_part(path, '|', 1) || '|' || split_part(path, '|', 2) AS node, tag, count(*) AS n, min(path) AS first
  FROM fx_path_tags GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY node ORDER BY n DESC, first) = 1""",
        "tags": """SELECT path, tag FROM fx_path_tags
UNION ALL SELECT p.path, two.tag FROM (SELECT DISTINCT path FROM fx_paths ANTI JOIN fx_path_tags USING (path)) p
JOIN two ON two.node = split_part(p.path, '|', 1) || '|' || split_part(p.path, '|', 2)""",
        "classes": """
SELECT c.hadm_id, list_sort(list(DISTINCT CASE WHEN tag > 14 THEN tag - 1 ELSE tag END)) AS ks
FROM fx_paths p JOIN coh c ON c.stay_id = (p.ord % 100) * 100 + p.ord % 10 JOIN tags USING (path) WHERE tag <> 14 GROUP BY c.hadm_id""",
    }
    | coded_class("final_acuity", ACUITY_TEXT)
    | coded_class("imminent_discharge", DISCHARGE_TEXT)
    | {
        "seen_stays": """SELECT stay_id, CASE WHEN row_number() OVER (PARTITION BY hadm_id ORDER BY stay_id DESC) = 1 THEN 0 ELSE 1 END AS readmission
FROM coh""",
    }
    | RUN_STEPS
    | {
        "observed": f"""
SELECT stay_id, offset_min AS time_min, 0 AS table_no, event_id AS row_key, offset_min, event_type AS a, value AS b, props AS c
FROM offsets JOIN coh USING (stay_id) WHERE offset_min BETWEEN 0 AND {OBS * 60}""",
        "texts": unit_texts(0, "events", {"at": "offset_min", "event_type": "a", "value": "b", "props": "c"}),
    },
    recursive=True,
    select=f"""
SELECT a.stay_id, a.patient_id, readmission, {dies(PRED)} AS mortality, {dies(LONG_TERM)} AS long_term_mortality,
       CAST(los > 3 AS INTEGER) AS los_3day, CAST(los > 7 AS INTEGER) AS los_7day, final_acuity, imminent_discharge,
       CASE WHEN ks IS NULL THEN '' ELSE {text_of('ks')} END AS diagnosis,
       {RISING.format(v='m.a')} AS rising, {FALLING.format(v='m.b')} AS falling, {BANDED.format(v='m.c')} AS banded,
       CASE WHEN dropped.patient_id IS NULL THEN {RISING.format(v='m.d')} END AS untreated, split_42, split_7, CAST(events AS INTEGER) AS events,
       {text_of(padded('f.a', RUN_TOKENS))} AS ids, {text_of(padded('f.c', RUN_TOKENS))} AS dpes, {text_of('time')} AS time
FROM active a JOIN seen_stays USING (stay_id) JOIN final_acuity_codes USING (stay_id) JOIN imminent_discharge_codes USING (stay_id)
JOIN chains f USING (stay_id) JOIN times USING (stay_id) JOIN wide ON wide.patient_id = a.patient_id LEFT JOIN means m USING (stay_id)
LEFT JOIN classes ON classes.hadm_id = a.hadm_id LEFT JOIN dropped ON dropped.patient_id = a.patient_id""",
)


def registered() -> dict[str, str]:
    return {
        "read_table": SCAN,
        "normalize_stays_anchor": NORMAL_ANCHOR,
        "normalize_stays_birthdate": NORMAL_BIRTH,
        "normalize_stays_capped": NORMAL_CAPPED,
        "select_cohort": SELECT_COHORT,
        "label_readmission": READMISSION,
        "first_stay": FIRST_STAY,
        "label_death_within": dies_within(PRED, "mortality"),
        "label_long_term_death": dies_within(
            LONG_TERM, "long_term_mortality", "coalesce(hos_discharge_location = 'Death', false) OR in_icu_mortality"
        ),
        "label_los": LOS,
        "label_final_acuity": ACUITY,
        "label_imminent_discharge": DISCHARGE,
        "encode_classes": CLASSES,
        "crosswalk_codes": CROSSWALK,
        "crosswalk_codes_backoff": BACKOFF,
        "convert_versions": CONVERT,
        "label_code_set": code_set(14, ""),
        "label_code_set_empty": code_set(3, "LEFT"),
        "explode_code_list": PATH_CODES,
        "path_categories": PATH_CATEGORIES,
        "hierarchy_vote": VOTE,
        "label_measurement": MEASURED,
        "first_exclusion": FIRST_EXCL,
        "before_first_exclusion": BEFORE_EXCL,
        "drop_multi_stay_excluded": MULTI_STAY,
        "attach_by_stay": BY_STAY,
        "attach_by_admission": BY_ADMISSION,
        "observation_window": WINDOW,
        "observation_window_offsets": WINDOW_OFFSETS,
        "describe_codes": DESCRIBED,
        "event_units": UNITS,
        "union_events": UNION,
        "round_decimals": ROUND,
        "space_digits": SPACE,
        "digit_places": PLACES,
        "word_pieces": WORD_PIECES,
        "fold_accents": "SELECT doc_id, strip_accents(lower(text)) AS text FROM documents",
        "encode_texts": ENCODED_TEXTS,
        "encode_events": ENCODED_EVENTS,
        "cut_history": CUT,
        "cut_history_unlimited": CUT_UNLIMITED,
        "pack_hierarchical": HIERARCHICAL,
        "pack_flat": FLAT,
        "split_patients": SPLIT,
        "keep_active": ACTIVE,
        "skipped_stays": SKIPPED,
        "write_dataset": WRITTEN,
        "read_cohort": COHORT_FILE,
        "stage_reuse": STAGED,
        "stage_by_bucket": BUCKETED,
        "read_csv": CSV_FILES,
        "read_checked": CHECKED_FILE,
        "read_categories": CATEGORIES,
        "read_crosswalk": CROSSWALK_FILE,
        "read_dictionary": DICTIONARY,
        "training_view": TRAINING,
        "training_view_flat": TRAINING_FLAT,
        "class_counts": CLASS_COUNTS,
        "batch_view": BATCHES,
        "whole_run": WHOLE,
        "whole_run_offsets": WHOLE_OFFSETS,
    }
