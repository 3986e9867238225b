"""DuckDB statements that compute every named query straight from the given tables.

Written the plain way (global windows, theta join, set operations) on purpose: they are
what the Spark plans are compared with.
"""

from __future__ import annotations

import re

from tillroll.operators.dimensions import COUNTRIES
from tillroll.functions.codes import MACRO_SEGMENTS, SEGMENT_CODES, SEGMENT_LABELS
from tillroll.sources.schemas import RAW

NON_PRODUCT = "POST|DOT|M|BANK CHARGES|AMAZONFEE|ADJUST|S|D|C2|CRUK|TEST.*|gift_.*|PADS|DCGS.*"
STOCK = "(description IS NULL AND customer_id IS NULL AND price = 0)"
ODD_CODE = f"regexp_full_match(stock_code, '{NON_PRODUCT}', 's')"
VARIANT = "regexp_full_match(stock_code, '[0-9]{5}[A-Za-z]')"


def rat(n: str, d: str, places: int, factor: int = 1) -> str:
    scale = 2 * factor * 10**places
    whole = (
        f"((CAST({n} AS HUGEINT) * {scale} + CAST({d} AS HUGEINT)) "
        f"// (2 * NULLIF(CAST({d} AS HUGEINT), 0)))"
    )
    return f"(CAST({whole} AS DOUBLE) / {10**places})"


def pct(n: str, d: str, places: int) -> str:
    return rat(n, d, places, 100)


def cents(money: str) -> str:
    return f"CAST(({money}) * 100 AS HUGEINT)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def segment_case(code: str) -> str:
    arms = [
        "WHEN {} IN ({}) THEN '{}'".format(
            code, ", ".join(f"'{c}'" for c in codes.split()), segment
        )
        for segment, codes in SEGMENT_CODES.items()
    ]
    return f"CASE {' '.join(arms)} ELSE 'Unclassified' END"


def macro_case(segment: str) -> str:
    arms = [
        "WHEN {} IN ({}) THEN '{}'".format(segment, ", ".join(f"'{n}'" for n in names), macro)
        for macro, names in MACRO_SEGMENTS.items()
    ]
    return f"CASE {' '.join(arms)} ELSE 'Z.UNCLASSIFIED' END"


def label_case(segment: str, default: str = "'Z.UNCLASSIFIED'") -> str:
    arms = [f"WHEN '{name}' THEN '{label}'" for name, label in SEGMENT_LABELS.items()]
    return f"CASE {segment} {' '.join(arms)} ELSE {default} END"


CODE = "CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR)"
RECENCY_BIN = """CASE WHEN recency BETWEEN 0 AND 7 THEN 'A.0-7 days'
    WHEN recency BETWEEN 8 AND 30 THEN 'B.8-30 days'
    WHEN recency BETWEEN 31 AND 90 THEN 'C.31-90 days'
    WHEN recency BETWEEN 91 AND 180 THEN 'D.91-180 days' ELSE 'E.>180 days' END"""
FREQUENCY_BIN = """CASE WHEN frequency >= 11 THEN 'A.>10 #' WHEN frequency >= 6 THEN 'B.6-10 #'
    WHEN frequency >= 3 THEN 'C.3-5 #' WHEN frequency = 2 THEN 'D.2 #' ELSE 'E.1 #' END"""
MONETARY_BIN = """CASE WHEN monetary > 10000 THEN 'A.>10k £' WHEN monetary > 3000 THEN 'B.3k-10k £'
    WHEN monetary > 1000 THEN 'C.1k-3k £' WHEN monetary > 300 THEN 'D.301-1k £'
    ELSE 'E.0-300 £' END"""


def scores(source: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"""SELECT *,
        CAST(6 - ntile(5) OVER ({part}ORDER BY recency, customer_id) AS INTEGER) AS r_score,
        CAST(ntile(5) OVER ({part}ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
        CAST(ntile(5) OVER ({part}ORDER BY monetary, customer_id) AS INTEGER) AS m_score
        FROM {source}"""


def history_base(calendar: str) -> str:
    return f"""SELECT c.snapshot_date, s.customer_id,
        CAST(date_diff('day', CAST(max(s.invoice_date) AS DATE), c.snapshot_date) + 1 AS INTEGER)
            AS recency,
        count(DISTINCT s.invoice_id) AS frequency,
        CAST(sum(s.line_amount) AS DECIMAL(18,2)) AS monetary
        FROM {calendar} c JOIN sales s ON CAST(s.invoice_date AS DATE) <= c.snapshot_date
        GROUP BY c.snapshot_date, s.customer_id"""


def history(base: str) -> str:
    return f"""SELECT *, {macro_case('rfm_segment')} AS macro_segment FROM (
        SELECT *, {segment_case(CODE)} AS rfm_segment FROM ({scores(base, 'snapshot_date')}))"""


_LINE = """
    SELECT CASE WHEN o_orderkey % 53 = 0 THEN 'C' ELSE '' END
            || CAST(500000 + o_orderkey AS VARCHAR) AS invoice,
        CASE l_partkey % 211 WHEN 0 THEN 'POST' WHEN 1 THEN 'M'
            WHEN 2 THEN 'gift_0001_' || CAST(l_partkey % 30 AS VARCHAR)
            WHEN 3 THEN 'TEST001' WHEN 4 THEN 'BANK CHARGES' WHEN 5 THEN 'MUG'
            ELSE CAST(10000 + l_partkey AS VARCHAR) || CASE WHEN l_partkey % 8 = 0
                THEN chr(CAST(65 + l_partkey % 24 AS INTEGER)) ELSE '' END END AS stock_code,
        CASE WHEN (l_orderkey * 7 + l_linenumber) % 241 = 0 OR l_partkey % 401 = 7 THEN NULL
            WHEN l_partkey % 37 = 0 THEN p_name ELSE upper(p_name) END AS description,
        CASE WHEN o_orderkey % 53 = 0 OR (l_orderkey + l_linenumber) % 307 = 0
            THEN -CAST(l_quantity AS INTEGER) ELSE CAST(l_quantity AS INTEGER) END AS quantity,
        o_orderdate AS invoice_date,
        CAST(CASE WHEN (l_orderkey * 5 + l_linenumber) % 1009 = 0 THEN NULL
            WHEN (l_orderkey * 7 + l_linenumber) % 241 = 0
                OR (l_orderkey * 3 + l_linenumber) % 587 = 0 THEN 0
            WHEN (l_orderkey + l_linenumber) % 1511 = 0 THEN -p_retailprice / 100
            ELSE p_retailprice / 100 END AS DECIMAL(10,3)) AS price,
        CAST(CASE WHEN o_orderkey % 9 = 0 OR (l_orderkey * 7 + l_linenumber) % 241 = 0 THEN NULL
            WHEN o_custkey % 20 = 0 OR o_orderkey % 16 < 10 THEN o_custkey * 10
            ELSE o_custkey * 10 + o_orderkey % 16 - 9 END AS BIGINT) AS customer_id,
        n_name AS country
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey"""

SHARED = {
    "raw": f"{_LINE} UNION ALL {_LINE} WHERE l_orderkey % 101 = 0 AND l_linenumber = 1",
    "stock_movements": f"SELECT * FROM raw WHERE {STOCK}",
    "cancellations": f"SELECT * FROM raw WHERE invoice LIKE 'C%' AND NOT {STOCK}",
    "non_product_lines": (
        f"SELECT * FROM raw WHERE {ODD_CODE} AND invoice NOT LIKE 'C%' AND NOT {STOCK}"
    ),
    "sale_lines": f"""SELECT * FROM raw WHERE customer_id IS NOT NULL AND invoice NOT LIKE 'C%'
        AND quantity > 0 AND price > 0 AND NOT {ODD_CODE}""",
    "sales": """SELECT invoice AS invoice_id, stock_code, description, quantity, invoice_date,
        price AS unit_price, customer_id, country,
        CAST(quantity * price AS DECIMAL(12,2)) AS line_amount FROM sale_lines""",
    "return_events": """SELECT customer_id, stock_code, invoice_date AS t, 1 AS k, invoice,
        -sum(quantity) AS units FROM cancellations WHERE quantity < 0 GROUP BY ALL
        UNION ALL SELECT customer_id, stock_code, invoice_date, 0, invoice_id, sum(quantity)
        FROM sales GROUP BY ALL""",
    "return_runs": """SELECT *, sum(CASE WHEN k = 0 THEN units ELSE 0 END) OVER w AS s,
        sum(CASE WHEN k = 1 THEN units ELSE 0 END) OVER w AS c FROM return_events
        WHERE customer_id IS NOT NULL AND stock_code IS NOT NULL AND t IS NOT NULL
        WINDOW w AS (PARTITION BY customer_id, stock_code ORDER BY t, k, invoice
            ROWS UNBOUNDED PRECEDING)""",
    "return_short": """SELECT *, greatest(0, max(c - s) OVER (
        PARTITION BY customer_id, stock_code ORDER BY t, k, invoice ROWS UNBOUNDED PRECEDING)) AS u
        FROM return_runs""",
    "return_given": """SELECT *, c - u AS e, units - u + coalesce(lag(u) OVER (
        PARTITION BY customer_id, stock_code ORDER BY t, k, invoice), 0) AS given
        FROM return_short""",
    "return_links": """SELECT r.invoice AS cancellation, r.t AS cancelled_at, r.customer_id,
        r.stock_code, s.invoice, s.t AS sold_at,
        CAST(least(s.s, r.e) - greatest(s.s - s.units, r.e - r.given) AS BIGINT) AS units
        FROM return_given r JOIN return_given s
            ON r.customer_id = s.customer_id AND r.stock_code = s.stock_code AND r.k = 1 AND s.k = 0
            AND s.s - s.units < r.e AND r.e - r.given < s.s
        UNION ALL SELECT invoice, t, customer_id, stock_code, NULL, NULL,
        CAST(units - given AS BIGINT) FROM return_given WHERE k = 1 AND given < units
        UNION ALL SELECT invoice, t, customer_id, stock_code, NULL, NULL, CAST(units AS BIGINT)
        FROM return_events WHERE k = 1 AND (customer_id IS NULL OR stock_code IS NULL OR t IS NULL)""",
    "bounds_of": """SELECT stock_code, max(n) AS n_lines,
        CAST(min(quantity) FILTER (100 * qr >= 99 * n) AS INTEGER) AS quantity_bound,
        min(unit_price) FILTER (100 * pr >= 99 * n) AS price_bound FROM (
        SELECT stock_code, quantity, unit_price, count(*) OVER (PARTITION BY stock_code) AS n,
            row_number() OVER (PARTITION BY stock_code ORDER BY quantity) AS qr,
            row_number() OVER (PARTITION BY stock_code ORDER BY unit_price) AS pr FROM sales)
        GROUP BY stock_code""",
    "capped": """SELECT *, CAST(quantity_capped * unit_price_capped AS DECIMAL(12,2)) AS line_amount_capped,
        quantity > quantity_capped OR unit_price > unit_price_capped AS is_capped FROM (
        SELECT s.*, least(quantity, quantity_bound) AS quantity_capped,
            least(unit_price, price_bound) AS unit_price_capped
        FROM sales s JOIN bounds_of b ON s.stock_code IS NOT DISTINCT FROM b.stock_code)""",
    "best_description": """SELECT stock_code, description AS best FROM (
        SELECT stock_code, description, count(*) AS n FROM raw
        WHERE stock_code IS NOT NULL AND description IS NOT NULL GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY n DESC, description) = 1""",
    "mended": """SELECT raw.* REPLACE (coalesce(description, best) AS description),
        CASE WHEN description IS NOT NULL THEN 'given' WHEN best IS NOT NULL THEN 'code' ELSE 'none' END
            AS description_source
        FROM raw LEFT JOIN best_description USING (stock_code)""",
    "line_copies": """SELECT *, count(*) AS copies FROM raw GROUP BY ALL""",
    "flagged": f"""SELECT *, customer_id IS NULL AND NOT coalesce({STOCK}, false) AS is_anonymous,
        coalesce(quantity < 0, false) AND NOT coalesce(invoice LIKE 'C%', false)
            AND NOT coalesce({STOCK}, false) AS is_adjustment,
        coalesce(price <= 0, false) AND NOT coalesce({STOCK}, false) AS is_freebie,
        CASE WHEN coalesce(price <= 0, false) AND NOT coalesce({STOCK}, false) THEN
            CASE WHEN description IS NULL OR description = lower(description) THEN 'note'
            ELSE 'product' END END AS freebie_kind,
        coalesce({ODD_CODE}, false) AS is_non_product FROM raw""",
    "variants": f"""SELECT stock_code, CASE WHEN {VARIANT} THEN left(stock_code, 5) ELSE stock_code END AS family_code,
        CASE WHEN {VARIANT} THEN right(stock_code, 1) END AS variant_code, count(*) AS n_lines
        FROM raw WHERE stock_code IS NOT NULL GROUP BY ALL""",
    "family_loads": f"""SELECT CASE WHEN {VARIANT} THEN left(stock_code, 5) ELSE stock_code END AS family_code,
        CASE WHEN min(coalesce(year(invoice_date), 9999)) < 1998 THEN 'first' ELSE 'second' END AS load
        FROM raw WHERE stock_code IS NOT NULL GROUP BY 1""",
    "families": """SELECT row_number() OVER (ORDER BY load, family_code) AS family_key, family_code, load
        FROM family_loads""",
    "country_names": "SELECT * FROM (VALUES {}) AS c(name, iso_code)".format(
        ", ".join("('{}', {})".format(n, f"'{c}'" if c else "NULL") for n, c in COUNTRIES.items())
    ),
    "country_mapped": """SELECT country, coalesce(iso_code, CASE WHEN status = 'unknown' THEN 'unknown' END)
        AS iso_code, status, n_lines FROM (
        SELECT country, iso_code, n_lines, CASE WHEN coalesce(trim(country), '') = ''
            OR (name IS NOT NULL AND iso_code IS NULL) THEN 'unknown'
            WHEN name IS NOT NULL THEN 'mapped' ELSE 'unmatched' END AS status
        FROM (SELECT CASE quantity % 17 WHEN 3 THEN left(country, 2) || substr(country, 2)
                WHEN 5 THEN left(country, 2) || substr(country, 4) WHEN 7 THEN 'xyz' || country
                ELSE country END AS country, count(*) AS n_lines FROM raw GROUP BY 1)
            LEFT JOIN country_names
            ON upper(trim(regexp_replace(country, '\\s+', ' ', 'g'))) = name)""",
    "rfm_base": """SELECT customer_id,
        CAST(date_diff('day', CAST(max(invoice_date) AS DATE),
            (SELECT CAST(max(invoice_date) AS DATE) FROM sales)) + 1 AS INTEGER) AS recency,
        count(DISTINCT invoice_id) AS frequency,
        CAST(sum(line_amount) AS DECIMAL(18,2)) AS monetary
        FROM sales GROUP BY customer_id""",
    "scored": scores("rfm_base"),
    "customers": f"SELECT *, {segment_case(CODE)} AS rfm_segment FROM scored",
    "enriched": f"""SELECT *, {label_case('rfm_segment')} AS segment_label,
        {macro_case('rfm_segment')} AS macro_segment FROM customers""",
    "coverage": f"""SELECT r, f, m, code, {segment_case('code')} AS rfm_segment FROM (
        SELECT CAST(a.i AS INTEGER) AS r, CAST(b.i AS INTEGER) AS f, CAST(c.i AS INTEGER) AS m,
            CAST(a.i AS VARCHAR) || CAST(b.i AS VARCHAR) || CAST(c.i AS VARCHAR) AS code
        FROM range(1, 6) a(i), range(1, 6) b(i), range(1, 6) c(i))""",
    "first_purchases": """SELECT customer_id, CAST(min(invoice_date) AS DATE) AS first_purchase_dt,
        CAST(date_trunc('month', min(invoice_date)) AS DATE) AS acquisition_month
        FROM sales GROUP BY customer_id""",
    "bounds": """SELECT CAST(min(invoice_date) AS DATE) AS a, CAST(max(invoice_date) AS DATE) AS b
        FROM sales""",
    "calendar": """SELECT last_day(CAST(m AS DATE)) AS snapshot_date FROM (
        SELECT unnest(generate_series(CAST(date_trunc('month', a) AS TIMESTAMP),
            CAST(b AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM bounds)""",
    "calendar_iterative": """SELECT CAST(m AS DATE) AS snapshot_date FROM (
        SELECT unnest(generate_series(CAST(last_day(a) AS TIMESTAMP),
            CAST(last_day(b) AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM bounds)""",
    "history_base": history_base("calendar"),
    "history_base_iterative": history_base("calendar_iterative"),
    "history": history("history_base"),
    "history_iterative": history("history_base_iterative"),
    "movements": f"""SELECT h.snapshot_date, macro_segment, count(*) AS n_users,
        {pct('count(*)', 'n_total', 2)} AS pct_users
        FROM history h JOIN (SELECT snapshot_date, count(*) AS n_total FROM history GROUP BY 1) t
        USING (snapshot_date) GROUP BY h.snapshot_date, macro_segment, n_total""",
    "last_two": "SELECT DISTINCT snapshot_date AS d FROM calendar ORDER BY d DESC LIMIT 2",
    "top_products": """SELECT segment_label, stock_code, description, revenue FROM (
        SELECT *, row_number() OVER (PARTITION BY segment_label
            ORDER BY revenue DESC, stock_code NULLS LAST, description NULLS LAST) AS rk
        FROM (SELECT segment_label, stock_code, description,
            CAST(sum(line_amount) AS DECIMAL(18,2)) AS revenue
            FROM sales JOIN enriched USING (customer_id) GROUP BY 1, 2, 3)) WHERE rk <= 5""",
}
for _level, _column in (("macro", "macro_segment"), ("detailed", "rfm_segment")):
    SHARED[f"moves_{_level}"] = f"""SELECT COALESCE(f.s, 'NOUVEAUX') AS seg_from,
        COALESCE(t.s, 'DISPARUS') AS seg_to, count(*) AS n_customers
        FROM (SELECT customer_id, {_column} AS s FROM history
            WHERE snapshot_date = (SELECT min(d) FROM last_two)) f
        FULL OUTER JOIN (SELECT customer_id, {_column} AS s FROM history
            WHERE snapshot_date = (SELECT max(d) FROM last_two)) t USING (customer_id)
        GROUP BY 1, 2"""


def with_shared(statement: str) -> str:
    """Prefix the statement with the shared tables it needs, directly or not."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)", text))
        for name in words & SHARED.keys() - needed:
            needed.add(name)
            visit(SHARED[name])

    visit(statement)
    ctes = [f"{name} AS (\n{SHARED[name]}\n)" for name in SHARED if name in needed]
    return f"WITH {', '.join(ctes)}\n{statement}" if ctes else statement


RAW_COLUMNS = ", ".join(
    "CAST(price AS DOUBLE) AS price" if c == "price" else c for c in RAW.names
)


def _profile() -> str:
    def row(column: str, metric: str, value: str) -> str:
        return f"SELECT '{column}' AS column_name, '{metric}' AS metric, {dbl(value)} AS value FROM raw"

    rows = []
    for c in RAW.names:
        rows += [row(c, "non_null", f"count({c})"), row(c, "unique", f"count(DISTINCT {c})")]
        if c in ("invoice", "stock_code", "description", "country"):
            rows += [
                row(c, "min_length", f"min(length({c}))"),
                row(c, "max_length", f"max(length({c}))"),
            ]
        scale = {"quantity": 1, "price": 1000, "customer_id": 1}.get(c)
        if scale:
            whole = f"CAST({c} * {scale} AS HUGEINT)"
            rows += [
                row(c, "min", f"min({c})"),
                row(c, "max", f"max({c})"),
                row(c, "mean", rat(f"sum({whole})", f"count({c}) * {scale}", 2)),
                row(c, "median", f"median(CAST({c} AS DOUBLE))"),
                row(c, "stddev", f"round(stddev_samp(CAST({c} AS DOUBLE)), 2)"),
            ]
    return " UNION ALL ".join(rows)


def _box(source: str, value: str, scale: int, group: str = "") -> str:
    """Quartiles from row numbers in whole hundredths, fences doubled."""
    over = f"PARTITION BY {group}" if group else ""
    key = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    join = f"USING ({group})" if group else "ON true"

    def quartile(p: int, name: str) -> str:
        below = f"((n - 1) * {p}) // 100"
        rest = f"((max(n) - 1) * {p}) % 100"
        return (
            f"max(CASE WHEN i = {below} THEN x END) * (100 - {rest})"
            f" + COALESCE(max(CASE WHEN i = {below} + 1 THEN x END), 0) * ({rest}) AS {name}"
        )

    unit = 100 * scale
    return f"""
    SELECT {key}count(*) AS n, {dbl('min(x)')} / {scale} AS min_value,
        {dbl('max(q1)')} / {unit} AS q1, {dbl('max(median)')} / {unit} AS median,
        {dbl('max(q3)')} / {unit} AS q3, {dbl('max(x)')} / {scale} AS max_value,
        {dbl('max(lo)')} / {2 * unit} AS lower_fence, {dbl('max(hi)')} / {2 * unit} AS upper_fence,
        {dbl('min(CASE WHEN ok THEN x END)')} / {scale} AS whisker_low,
        {dbl('max(CASE WHEN ok THEN x END)')} / {scale} AS whisker_high,
        count(*) FILTER (NOT ok) AS n_outliers
    FROM (SELECT *, x * 200 BETWEEN lo AND hi AS ok FROM (
        SELECT *, q1 * 2 - (q3 - q1) * 3 AS lo, q3 * 2 + (q3 - q1) * 3 AS hi
        FROM (SELECT {key}CAST({value} AS BIGINT) AS x FROM {source}) v
        JOIN (SELECT {key}{quartile(25, 'q1')}, {quartile(50, 'median')}, {quartile(75, 'q3')}
            FROM (SELECT {key}CAST({value} AS BIGINT) AS x,
                row_number() OVER ({over} ORDER BY {value}) - 1 AS i,
                count(*) OVER ({over}) AS n FROM {source}) {by}) q {join})) {by}"""


def _check(dataset: str, check: str, value: str, source: str, threshold: str, test: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, '{check}' AS "check", {dbl('v')} AS value,
        '{threshold}' AS threshold, COALESCE({test}, false) AS passed
        FROM (SELECT {value} AS v FROM {source})"""


def _count_between(dataset: str, source: str, low: int, high: int) -> str:
    return _check(
        dataset, "row_count", "count(*)", source, f"between {low} and {high}",
        f"v BETWEEN {low} AND {high}",
    )


def _zero(dataset: str, check: str, source: str, where: str) -> str:
    return _check(dataset, check, f"count(*) FILTER ({where})", source, "= 0", "v = 0")


def _duplicates(dataset: str, columns: str, source: str, threshold: str) -> str:
    some = " AND ".join(f"{c} IS NOT NULL" for c in columns.split(", "))
    return _check(
        dataset,
        f"duplicate_count({columns})",
        "count(*)",
        f"(SELECT {columns} FROM {source} WHERE {some} GROUP BY ALL HAVING count(*) > 1)",
        threshold,
        f"v {threshold}",
    )


def _dq_customer() -> str:
    rows = [_count_between("customer_rfm", "customers", 5500, 5943)]
    for c in ("r_score", "f_score", "m_score"):
        rows.append(_check("customer_rfm", f"min({c})", f"min({c})", "customers", ">= 1", "v >= 1"))
        rows.append(_check("customer_rfm", f"max({c})", f"max({c})", "customers", "<= 5", "v <= 5"))
    rows.append(
        _zero("customer_rfm", "invalid_count(rfm_segment)", "customers", "rfm_segment = 'TBD'")
    )
    rows.append(
        _check("customer_rfm", "min(monetary)", "min(monetary)", "customers", "> 0", "v > 0")
    )
    return " UNION ALL ".join(rows)


def _dq_raw() -> str:
    rows = [_count_between("raw", "raw", 1060000, 1075000)]
    for c in ("invoice", "stock_code", "quantity", "price"):
        rows.append(_zero("raw", f"missing_count({c})", "raw", f"{c} IS NULL"))
    for c, below in (("customer_id", 25), ("description", 1)):
        missing = f"count(*) FILTER ({c} IS NULL)"
        rows.append(
            f"""SELECT 'raw' AS dataset, 'missing_percent({c})' AS "check",
            {dbl(rat(missing, 'count(*)', 4, 100))} AS value, '< {below}' AS threshold,
            {missing} * 100 < count(*) * {below} AS passed FROM raw"""
        )
    return " UNION ALL ".join(rows)


def _dq_classified(dataset: str, source: str) -> list[str]:
    return [
        _zero(dataset, "invalid_count(rfm_segment)", source, "rfm_segment = 'Unclassified'"),
        _zero(dataset, "invalid_count(macro_segment)", source, "macro_segment = 'Z.UNCLASSIFIED'"),
    ]


def _dq_constraints() -> str:
    scored = "customer_id recency frequency monetary r_score f_score m_score rfm_segment".split()
    sold = "invoice_id stock_code quantity invoice_date unit_price customer_id".split()
    required = (
        ("sales", "sales", sold),
        ("customer_rfm", "customers", scored),
        ("customer_rfm_history", "history", ["snapshot_date", *scored, "macro_segment"]),
    )
    rows = [
        _zero(dataset, f"missing_count({c})", source, f"{c} IS NULL")
        for dataset, source, columns in required
        for c in columns
    ]
    rows.append(_duplicates("customer_rfm", "customer_id", "customers", "= 0"))
    rows.append(_duplicates("customer_rfm_history", "snapshot_date, customer_id", "history", "= 0"))
    return " UNION ALL ".join(rows)


def _dq_sales() -> str:
    return " UNION ALL ".join(
        [
            _count_between("sales", "sales", 750000, 850000),
            _zero("sales", "missing_count(customer_id)", "sales", "customer_id IS NULL"),
            _zero("sales", "missing_count(invoice_id)", "sales", "invoice_id IS NULL"),
            _check("sales", "min(quantity)", "min(quantity)", "sales", "> 0", "v > 0"),
            _check("sales", "min(unit_price)", "min(unit_price)", "sales", "> 0", "v > 0"),
            _zero(
                "sales",
                "invalid_count(invoice_id)",
                "sales",
                "NOT regexp_full_match(invoice_id, '[0-9]+')",
            ),
            _count_between("stock_movements", "stock_movements", 4000, 5000),
            _count_between("cancellations", "cancellations", 18000, 21000),
        ]
    )


def _share(condition: str, places: int = 0) -> str:
    return pct(f"count(*) FILTER ({condition})", "count(*)", places)


def _mean(column: str, places: int) -> str:
    return rat(f"sum({column})", f"count({column})", places)


def _mean_money(column: str, places: int) -> str:
    return rat(cents(f"sum({column})"), f"count({column}) * 100", places)


def _bins(case: str, metric: str) -> str:
    return f"""SELECT bin_label, users, {pct('users', 'sum(users) OVER ()', 1)} AS pct_users, {metric}
        AS avg_metric FROM (SELECT {case} AS bin_label, count(*) AS users,
            sum(recency) AS days, sum(monetary) AS revenue FROM customers GROUP BY 1)"""


CUSTOMER = "customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary"
SCORES = "r_score, f_score, m_score"
HISTORY = f"snapshot_date, {CUSTOMER}, {SCORES}, rfm_segment, macro_segment"
TOP = """SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary,
    rfm_segment AS segment FROM customers {} ORDER BY customers.monetary DESC, customer_id LIMIT 500"""
BARE = f"SELECT {RAW_COLUMNS} FROM raw WHERE description IS NULL AND stock_code {{}} IN (SELECT DISTINCT stock_code FROM raw WHERE description IS NOT NULL)"
FREE = """SELECT description, count(*) AS n FROM raw WHERE price = 0 {} GROUP BY 1
    ORDER BY n DESC, description NULLS FIRST LIMIT {}"""
COPIES = f"SELECT {', '.join(RAW.names)}, count(*) AS copies FROM raw GROUP BY ALL"


def _statements() -> dict[str, str]:
    q = {
        "raw_ingest_union": f"SELECT {RAW_COLUMNS} FROM raw",
        "ingest_audit": """SELECT count(*) AS rows_inserted, count(customer_id) AS rows_with_customer,
            lower(any_value(typeof(customer_id))) AS customer_id_type,
            abs(count(*) - 1067371) <= 100 AS volume_ok FROM raw""",
        "clean_rejected": f"""SELECT {RAW_COLUMNS} FROM raw
            WHERE COALESCE({STOCK}, false) = false
            AND COALESCE(invoice LIKE 'C%' AND NOT {STOCK}, false) = false
            AND COALESCE({ODD_CODE} AND invoice NOT LIKE 'C%' AND NOT {STOCK}, false) = false
            AND COALESCE(customer_id IS NOT NULL AND invoice NOT LIKE 'C%' AND quantity > 0
                AND price > 0 AND NOT {ODD_CODE}, false) = false""",
        "cancellation_links": "SELECT * FROM return_links",
        "cancellation_link_summary": f"""SELECT *, {pct('units_linked', 'units_cancelled', 2)}
            AS pct_units_linked FROM (SELECT count(*) AS n_cancelled,
            count(*) FILTER (linked > 0) AS n_linked,
            {big('coalesce(sum(units), 0)')} AS units_cancelled,
            {big('coalesce(sum(linked), 0)')} AS units_linked FROM (
            SELECT sum(units) AS units, coalesce(sum(units) FILTER (invoice IS NOT NULL), 0) AS linked
            FROM return_links GROUP BY cancellation, customer_id, stock_code))""",
        "sales_net_of_cancellations": f"""SELECT *, units_sold - units_returned AS units_kept FROM (
            SELECT s.customer_id, s.stock_code, s.invoice, s.t AS sold_at,
            {big('s.units')} AS units_sold, {big('sum(l.units)')} AS units_returned
            FROM return_events s JOIN return_links l ON l.customer_id = s.customer_id
                AND l.stock_code = s.stock_code AND l.invoice = s.invoice AND l.sold_at = s.t
            WHERE s.k = 0 GROUP BY ALL)""",
        "product_p99_bounds": "SELECT * REPLACE (CAST(price_bound AS DOUBLE) AS price_bound) FROM bounds_of",
        "winsorised_sales": """SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price,
            CAST(line_amount AS DOUBLE) AS line_amount, CAST(unit_price_capped AS DOUBLE) AS unit_price_capped,
            CAST(line_amount_capped AS DOUBLE) AS line_amount_capped) FROM capped""",
        "winsorised_products": f"""SELECT stock_code, count(*) AS n_lines,
            count(*) FILTER (is_capped) AS n_capped, {dbl('sum(line_amount)')} AS revenue,
            {dbl('sum(line_amount_capped)')} AS revenue_capped FROM capped GROUP BY 1""",
        "repaired_lines": f"SELECT {RAW_COLUMNS}, description_source FROM mended",
        "repair_counts": """SELECT description_source, count(*) AS n_lines,
            count(DISTINCT stock_code) AS n_codes FROM mended GROUP BY 1""",
        "deduplicated_lines": f"SELECT DISTINCT {RAW_COLUMNS} FROM raw",
        "deduplicated_plausible": f"""SELECT {RAW_COLUMNS} FROM raw WHERE quantity > 1
            UNION ALL SELECT DISTINCT {RAW_COLUMNS} FROM raw WHERE quantity <= 1 OR quantity IS NULL""",
        "removal_ledger": f"""SELECT {RAW_COLUMNS}, copies, CAST(1 AS BIGINT) AS n_kept,
            copies - 1 AS n_removed FROM line_copies WHERE copies > 1""",
        "non_product_subtypes": f"""SELECT CASE WHEN stock_code IN ('POST', 'DOT', 'C2') THEN 'postage'
            WHEN stock_code IN ('BANK CHARGES', 'AMAZONFEE', 'CRUK') THEN 'fee'
            WHEN stock_code IN ('M', 'ADJUST', 'D', 'S') THEN 'adjustment'
            WHEN stock_code LIKE 'gift@_%' ESCAPE '@' THEN 'gift_card'
            WHEN stock_code LIKE 'TEST%' THEN 'test' ELSE 'other' END AS subtype, count(*) AS n_lines,
            count(DISTINCT stock_code) AS n_codes, {big('sum(quantity)')} AS units
            FROM non_product_lines GROUP BY 1""",
        "flagged_lines": "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM flagged",
        "flag_counts": f"""SELECT is_anonymous, is_adjustment, is_freebie, freebie_kind, is_non_product,
            count(*) AS n_lines, count(*) FILTER (quantity > 0) AS n_positive,
            {dbl('sum(quantity * price)')} AS amount FROM flagged GROUP BY ALL""",
        "product_families": "SELECT * FROM families",
        "product_dimension": """SELECT stock_code, family_key, family_code, variant_code, n_lines
            FROM variants JOIN families USING (family_code)""",
        "country_map": "SELECT * FROM country_mapped",
        "country_suggestions": """SELECT country, name AS suggestion, c.iso_code,
            CAST(levenshtein(upper(country), name) AS INTEGER) AS distance, n_lines
            FROM country_mapped m JOIN country_names c ON levenshtein(upper(country), name) <= 2
            WHERE status = 'unmatched'
            QUALIFY row_number() OVER (PARTITION BY country ORDER BY distance, name) = 1""",
        "snapshot_quantiles_sketched": """SELECT snapshot_date, measure, percent, n, true AS within_error
            FROM (SELECT snapshot_date, count(*) AS n FROM history GROUP BY 1),
            (VALUES ('recency'), ('frequency'), ('monetary')) AS m(measure),
            (VALUES (25), (50), (75)) AS p(percent)""",
        "span_quantiles_sketched": """SELECT measure, percent, n, true AS within_error
            FROM (SELECT count(*) AS n FROM history
                WHERE snapshot_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'),
            (VALUES ('recency'), ('frequency'), ('monetary')) AS m(measure),
            (VALUES (25), (50), (75)) AS p(percent) WHERE n > 0""",
        "distinct_sketched": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count({c}) AS non_null, true AS within_error FROM raw"
            for c in RAW.names
        ),
        "repair_codes_sketched": """SELECT count(*) AS codes_total,
            count(*) FILTER (described) AS codes_recoverable, count(*) FILTER (NOT described) AS codes_lost
            FROM (SELECT stock_code, bool_or(description IS NOT NULL) AS described FROM raw
                WHERE stock_code IS NOT NULL GROUP BY 1 HAVING bool_or(description IS NULL))""",
        "clean_sales": """SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price,
            CAST(line_amount AS DOUBLE) AS line_amount) FROM sales""",
        "clean_audit": f"""SELECT *, n_raw - n_total_routed AS n_rejected,
            {pct('n_raw - n_total_routed', 'n_raw', 2)} AS pct_rejected FROM (
            SELECT *, n_stock_movements + n_cancellations + n_non_product_lines + n_sales
                AS n_total_routed FROM (SELECT (SELECT count(*) FROM raw) AS n_raw,
            (SELECT count(*) FROM stock_movements) AS n_stock_movements,
            (SELECT count(*) FROM cancellations) AS n_cancellations,
            (SELECT count(*) FROM non_product_lines) AS n_non_product_lines,
            (SELECT count(*) FROM sale_lines) AS n_sales))""",
        "rfm_base": f"SELECT {CUSTOMER} FROM rfm_base",
        "rfm_scores": f"SELECT {CUSTOMER}, {SCORES} FROM scored",
        "rfm_segments": f"SELECT {CUSTOMER}, {SCORES}, rfm_segment FROM customers",
        "rfm_enriched": f"""SELECT {CUSTOMER}, {SCORES}, rfm_segment, segment_label, macro_segment
            FROM enriched""",
        "code_coverage": f"""SELECT r, f, m, code, coverage.rfm_segment,
            {macro_case('coverage.rfm_segment')} AS macro_segment, count(customer_id) AS n_customers
            FROM coverage LEFT JOIN customers ON r = r_score AND f = f_score AND m = m_score
            GROUP BY ALL""",
        "first_purchase": "SELECT * FROM first_purchases",
        "snapshot_calendar": "SELECT * FROM calendar",
        "snapshot_calendar_iterative": "SELECT * FROM calendar_iterative",
        "history_base": f"SELECT snapshot_date, {CUSTOMER} FROM history_base",
        "history_base_iterative": f"SELECT snapshot_date, {CUSTOMER} FROM history_base_iterative",
        "history_scores": f"SELECT {HISTORY} FROM history",
        "history_scores_iterative": f"SELECT {HISTORY} FROM history_iterative",
        "history_volumes": """SELECT count(*) AS total_rows, count(DISTINCT snapshot_date)
            AS n_snapshots, min(snapshot_date) AS first_snap, max(snapshot_date) AS last_snap
            FROM history""",
        "macro_last_snapshot": """SELECT macro_segment, count(*) AS n_users FROM history
            WHERE snapshot_date = (SELECT max(snapshot_date) FROM history) GROUP BY 1""",
        "snapshot_dates": "SELECT DISTINCT snapshot_date FROM history",
        "kpis": f"""SELECT count(*) AS total_customers, {_mean('recency', 1)} AS avg_recency,
            {_mean_money('monetary', 0)} AS avg_monetary,
            count(DISTINCT rfm_segment) AS n_segments FROM customers""",
        "kpi_bar": f"""SELECT (SELECT count(*) FROM raw) AS total_raw_lines,
            (SELECT count(*) FROM sales) AS total_clean_lines, count(*) AS total_users,
            (SELECT count(DISTINCT invoice_id) FROM sales) AS total_transactions,
            (SELECT CAST(sum(line_amount) AS DOUBLE) FROM sales) AS total_net_revenue,
            CAST({_mean('recency', 0)} AS INTEGER) AS adslt, {_mean('frequency', 1)} AS atpu,
            {_mean_money('monetary', 0)} AS arpu,
            {_share('frequency = 1 AND recency <= 90')} AS pct_new,
            {_share('frequency > 1 AND recency <= 180')} AS pct_returning,
            {_share('recency > 180')} AS pct_churned FROM customers""",
        "recency_kpis": f"""SELECT CAST(trunc(avg(recency)) AS INTEGER) AS mean_recency,
            {_share('recency <= 7')} AS pct_recent, {_share('recency > 180')} AS pct_churned
            FROM customers""",
        "frequency_kpis": f"""SELECT {_mean('frequency', 1)} AS mean_frequency,
            {_share('frequency = 1')} AS pct_one_timers,
            {_share('frequency >= 11')} AS pct_frequent FROM customers""",
        "monetary_kpis": f"""SELECT {_mean_money('monetary', 0)} AS mean_monetary,
            round(median(CAST(monetary AS DOUBLE)), 0) AS median_monetary,
            {_share('monetary > 3000')} AS pct_high_value FROM customers""",
        "glossary_metrics": f"""SELECT (SELECT {rat(cents('sum(line_amount)'),
            'count(DISTINCT invoice_id) * 100', 2)} FROM sales) AS atv,
            {_share('frequency = 1', 1)} AS pct_one_timers,
            {_share('m_score = 5', 1)} AS pct_top_spenders FROM customers""",
        "segment_distribution": f"""SELECT rfm_segment AS segment, count(*) AS n,
            {_mean_money('monetary', 0)} AS avg_monetary, {_mean('recency', 1)} AS avg_recency,
            {_mean('frequency', 1)} AS avg_frequency FROM customers GROUP BY 1""",
        "segment_kpi_table": f"""SELECT segment_label, max(macro_segment) AS macro_segment,
            count(*) AS total_users, {pct('count(*)', 'sum(count(*)) OVER ()', 1)} AS pct_users,
            {pct(cents('sum(monetary)'), cents('sum(sum(monetary)) OVER ()'), 1)} AS pct_revenue,
            {pct('sum(frequency)', 'sum(sum(frequency)) OVER ()', 1)} AS pct_tx,
            CAST({_mean('recency', 0)} AS INTEGER) AS avg_recency,
            {_mean('frequency', 1)} AS avg_frequency, {_mean_money('monetary', 0)} AS avg_monetary
            FROM enriched GROUP BY 1""",
        "bubble_segments": f"""SELECT segment_label, CAST({_mean('recency', 0)} AS INTEGER) AS adslt,
            CAST(sum(monetary) AS DOUBLE) AS total_revenue, count(*) AS total_users
            FROM enriched GROUP BY 1""",
        "rf_heatmap": 'SELECT r_score, f_score, count(*) AS "count" FROM customers GROUP BY 1, 2',
        "all_segments": "SELECT DISTINCT rfm_segment FROM customers",
        "monetary_by_segment": """SELECT rfm_segment AS segment, CAST(monetary AS DOUBLE) AS monetary
            FROM customers""",
        "recency_distribution": "SELECT recency FROM customers",
        "frequency_distribution": "SELECT frequency FROM customers",
        "monetary_distribution": "SELECT CAST(monetary AS DOUBLE) AS monetary FROM customers",
        "recency_bins": _bins(RECENCY_BIN, f"CAST({rat('days', 'users', 0)} AS INTEGER)"),
        "frequency_bins": f"""SELECT bin_label, count(DISTINCT customer_id) AS users,
            {pct('count(DISTINCT customer_id)', 'sum(count(DISTINCT customer_id)) OVER ()', 1)}
                AS pct_users, {pct('sum(tx)', 'sum(sum(tx)) OVER ()', 1)} AS avg_metric
            FROM (SELECT bin_label, b.customer_id, count(DISTINCT s.invoice_id) AS tx
                FROM (SELECT customer_id, {FREQUENCY_BIN} AS bin_label FROM customers) b
                LEFT JOIN sales s USING (customer_id) GROUP BY 1, 2) GROUP BY 1""",
        "monetary_bins": _bins(
            MONETARY_BIN, pct(cents("revenue"), cents("sum(revenue) OVER ()"), 1)
        ),
        "top_customers": TOP.format(""),
        "top_customers_filtered": TOP.format(
            "WHERE rfm_segment IN ('Champions', 'Loyal Customers')"
        ),
        "scatter_sample": """SELECT customer_id, recency, CAST(monetary AS DOUBLE) AS monetary,
            segment_label FROM enriched WHERE enriched.monetary > 0
            ORDER BY md5(CAST(customer_id AS VARCHAR)), customer_id LIMIT 1500""",
        "top_products_by_segment": """SELECT segment_label, stock_code, description,
            CAST(revenue AS DOUBLE) AS revenue FROM top_products""",
        "top_products_nested": """SELECT segment_label, string_agg(stock_code || '|' ||
            COALESCE(description, '') || '|' || CAST(revenue AS VARCHAR), ';'
            ORDER BY revenue DESC, stock_code, description NULLS FIRST) AS products
            FROM top_products GROUP BY 1""",
        "monthly_revenue": """SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS "month",
            CAST(sum(line_amount) AS DOUBLE) AS revenue, count(DISTINCT invoice_id) AS n_invoices,
            count(DISTINCT customer_id) AS n_customers FROM sales GROUP BY 1""",
        "macro_movements": "SELECT * FROM movements",
        "acquisitions_trend": """SELECT acquisition_month, count(*) AS user_acquisitions
            FROM first_purchases GROUP BY 1""",
        "cohort_pivot": "SELECT acquisition_month, count(*) AS user_acquisitions, "
        + ", ".join(
            f"{_share(f'''macro_segment = '{m}' ''', 1)} AS pct_{m.split('.')[1].lower()}"
            for m in MACRO_SEGMENTS
        )
        + " FROM first_purchases JOIN enriched USING (customer_id) GROUP BY 1",
        "transitions_macro": "SELECT * FROM moves_macro",
        "transitions_detailed": f"""SELECT {label_case('seg_from', 'seg_from')} AS seg_from,
            {label_case('seg_to', 'seg_to')} AS seg_to, n_customers FROM moves_detailed""",
        "sankey_links": """SELECT CAST(dense_rank() OVER (ORDER BY seg_from) - 1 AS INTEGER) AS source,
            CAST((SELECT count(DISTINCT seg_from) FROM moves_macro)
                + dense_rank() OVER (ORDER BY seg_to) - 1 AS INTEGER) AS target,
            n_customers AS value, seg_from AS source_label, seg_to AS target_label
            FROM moves_macro""",
        "sankey_nodes": """SELECT CAST(row_number() OVER (ORDER BY side, label) - 1 AS INTEGER)
            AS node, side, label FROM (SELECT 'from' AS side, seg_from AS label FROM moves_macro
            UNION SELECT 'to', seg_to FROM moves_macro)""",
        "dq_raw": _dq_raw(),
        "dq_constraints": _dq_constraints(),
        "dq_clean_sales": _dq_sales(),
        "dq_customer_rfm": _dq_customer(),
        "dq_duplicates": _duplicates(
            "raw", "invoice, stock_code, customer_id, quantity", "raw", "< 50000"
        )
        + " UNION ALL "
        + _duplicates("customer_rfm", "customer_id", "customers", "= 0"),
        "dq_code_coverage": " UNION ALL ".join(
            [
                *_dq_classified("customer_rfm", "enriched"),
                *_dq_classified("customer_rfm_history", "history"),
                _count_between("code_coverage", "coverage", 125, 125),
                _zero(
                    "code_coverage",
                    "invalid_count(rfm_segment)",
                    "coverage",
                    "rfm_segment = 'Unclassified'",
                ),
                _zero(
                    "code_coverage",
                    "invalid_count(macro_segment)",
                    "coverage",
                    f"{macro_case('rfm_segment')} = 'Z.UNCLASSIFIED'",
                ),
            ]
        ),
        "column_profile": _profile(),
        "missing_by_column": " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS missing,
            {pct(f'count(*) - count({c})', 'count(*)', 2)} AS pct_missing FROM raw"""
            for c in RAW.names
        ),
        "date_span": 'SELECT min(invoice_date) AS "first", max(invoice_date) AS "last" FROM raw',
        "null_profile": """SELECT description IS NULL AS no_description, customer_id IS NULL
            AS no_customer, COALESCE(price = 0, false) AS zero_price, count(*) AS n
            FROM raw GROUP BY 1, 2, 3""",
        "description_recoverable": BARE.format(""),
        "description_unrecoverable": BARE.format("NOT"),
        "description_repair_summary": f"""SELECT *,
            {pct('codes_recoverable', 'codes_total', 1)} AS pct_codes_recoverable,
            {pct('lines_recoverable', 'lines_total', 1)} AS pct_lines_recoverable FROM (
            SELECT (SELECT count(*) FROM (SELECT DISTINCT stock_code FROM bare)) AS codes_total,
                (SELECT count(*) FROM (SELECT stock_code FROM bare INTERSECT
                    SELECT stock_code FROM told)) AS codes_recoverable,
                (SELECT count(*) FROM (SELECT stock_code FROM bare EXCEPT
                    SELECT stock_code FROM told)) AS codes_lost,
                (SELECT count(*) FROM bare) AS lines_total,
                (SELECT count(*) FROM bare WHERE stock_code IN (SELECT stock_code FROM told))
                    AS lines_recoverable,
                (SELECT count(*) FROM bare WHERE stock_code NOT IN (SELECT stock_code FROM told))
                    AS lines_lost)""",
        "quantity_anomalies": """SELECT count(*) FILTER (invoice LIKE 'C%') AS cancelled_lines,
            count(*) FILTER (quantity = 0) AS zero_quantity,
            count(*) FILTER (quantity < 0) AS negative_quantity,
            count(*) FILTER (quantity < 0 AND invoice LIKE 'C%') AS negative_cancelled,
            count(*) FILTER (quantity < 0 AND invoice NOT LIKE 'C%') AS negative_orphan FROM raw""",
        "price_anomalies": """SELECT count(*) FILTER (price = 0) AS zero_price,
            count(*) FILTER (price < 0) AS negative_price, CAST(min(price) AS DOUBLE) AS min_price,
            CAST(max(price) AS DOUBLE) AS max_price FROM raw""",
        "negative_price_lines": """SELECT invoice, stock_code, description,
            CAST(price AS DOUBLE) AS price FROM raw WHERE raw.price < 0""",
        "zero_price_descriptions": FREE.format("AND description IS NOT NULL", 10),
        "zero_price_descriptions_all": FREE.format("", 30),
        "special_stock_codes": """SELECT stock_code, count(*) AS n FROM raw
            WHERE NOT COALESCE(regexp_full_match(stock_code, '[0-9]+[A-Za-z]*'), false)
            GROUP BY 1 ORDER BY n DESC, stock_code NULLS FIRST LIMIT 20""",
        "alpha_stock_codes": """SELECT DISTINCT stock_code FROM raw
            WHERE regexp_matches(stock_code, '[a-zA-Z]')""",
        "lowercase_descriptions": """SELECT DISTINCT description FROM raw
            WHERE lower(description) = description AND upper(description) <> description""",
        "sku_variant_summary": f"""SELECT count(*) FILTER ({VARIANT}) AS variant_lines,
            count(DISTINCT stock_code) FILTER ({VARIANT}) AS variant_codes,
            count(DISTINCT stock_code[1:5]) FILTER ({VARIANT}) AS families,
            {rat(f'count(DISTINCT stock_code) FILTER ({VARIANT})',
                 f'count(DISTINCT stock_code[1:5]) FILTER ({VARIANT})', 1)} AS codes_per_family,
            {_share(VARIANT, 2)} AS pct_lines FROM raw""",
        "sku_variant_letters": f"""SELECT upper(stock_code[6:6]) AS letter, count(*) AS n FROM raw
            WHERE {VARIANT} GROUP BY 1""",
        "sku_variants_of_root": """SELECT stock_code, description, count(*) AS n FROM raw
            WHERE stock_code LIKE '1000%' GROUP BY 1, 2""",
        "exact_duplicates_summary": f"""SELECT count(*) FILTER (copies > 1) AS duplicated_values,
            CAST(sum(copies - 1) AS BIGINT) AS extra_lines,
            {pct('sum(copies - 1)', 'sum(copies)', 2)} AS pct_extra FROM ({COPIES})""",
        "exact_duplicates_sample": f"""SELECT {RAW_COLUMNS} FROM (
            SELECT *, count(*) OVER (PARTITION BY {', '.join(RAW.names)}) AS copies FROM raw) d
            WHERE copies > 1 ORDER BY invoice NULLS LAST, stock_code NULLS LAST,
            customer_id NULLS LAST, description NULLS LAST, quantity NULLS LAST,
            invoice_date NULLS LAST, d.price NULLS LAST, country NULLS LAST LIMIT 10""",
        "country_distribution": f"""SELECT CAST(place AS INTEGER) AS place,
            CASE WHEN place > 10 THEN 'others' ELSE country END AS country,
            CAST(sum(n) AS BIGINT) AS n, {pct('sum(n)', 'max(total)', 2)} AS pct FROM (
            SELECT country, n, least(row_number() OVER (ORDER BY n DESC, country NULLS LAST), 11)
                AS place, sum(n) OVER () AS total
            FROM (SELECT country, count(*) AS n FROM raw GROUP BY 1)) GROUP BY 1, 2""",
        "rf_heatmap_matrix": "SELECT f_score, "
        + ", ".join(f"count(*) FILTER (r_score = {r}) AS r{r}" for r in range(1, 6))
        + " FROM customers GROUP BY 1",
        "segment_treemap": f"""SELECT rfm_segment AS label, 'Tous segments' AS parent,
            count(*) AS n, {_mean_money('monetary', 0)} AS avg_monetary FROM customers GROUP BY 1
            UNION ALL SELECT 'Tous segments', '', count(*), {_mean_money('monetary', 0)}
            FROM customers""",
        "monetary_boxplot": _box("customers", "monetary * 100", 100, "rfm_segment"),
        "monetary_overall_boxplot": _box("customers", "monetary * 100", 100),
        "recency_boxplot": _box("customers", "recency", 1),
        "frequency_boxplot": _box("customers", "frequency", 1),
        "macro_movements_wide": "SELECT snapshot_date, "
        + ", ".join(
            f"max(CASE WHEN macro_segment = '{m}' THEN n_users END) AS n_{m.split('.')[1].lower()}"
            for m in MACRO_SEGMENTS
        )
        + ", "
        + ", ".join(
            f"max(CASE WHEN macro_segment = '{m}' THEN pct_users END)"
            f" AS pct_{m.split('.')[1].lower()}"
            for m in MACRO_SEGMENTS
        )
        + " FROM movements GROUP BY 1",
    }
    for name in ("stock_movements", "cancellations", "non_product_lines"):
        q[f"clean_{name}"] = f"SELECT {RAW_COLUMNS} FROM {name}"
    return q


SHARED["bare"] = "SELECT stock_code FROM raw WHERE description IS NULL AND stock_code IS NOT NULL"
SHARED["told"] = (
    "SELECT stock_code FROM raw WHERE description IS NOT NULL AND stock_code IS NOT NULL"
)


def statements() -> dict[str, str]:
    return {name: with_shared(sql) for name, sql in _statements().items()}
