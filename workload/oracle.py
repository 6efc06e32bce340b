"""The same results in plain SQL over the driver tables."""

from __future__ import annotations

from . import data

TXN = """
SELECT CAST(l.l_shipdate AS DATE) AS fecha,
       concat(CASE WHEN l.l_orderkey % 17 = 0 THEN 'Entre cuentas '
                   WHEN l.l_orderkey % 19 = 0 THEN 'Un pago amigo '
                   WHEN l.l_orderkey % 23 = 0 THEN 'Cargo Galaxia '
                   WHEN l.l_orderkey % 29 = 0 THEN 'Cargo Terraza '
                   WHEN l.l_orderkey % 31 = 0 THEN 'Noa aporta '
                   WHEN l.l_orderkey % 37 = 0 THEN 'Comisión ' ELSE '' END,
              p.p_name, ' ', p.p_type, ' ', p.p_brand) AS concepto,
       CAST(CASE WHEN l.l_orderkey % 31 = 0 THEN 320.0 WHEN l.l_orderkey % 41 = 0 THEN 0.0
            WHEN l.l_returnflag = 'R' THEN l.l_extendedprice ELSE -l.l_extendedprice END AS DOUBLE) AS importe,
       CASE WHEN l.l_suppkey % 5 <= 2 THEN 'Bank1' WHEN l.l_suppkey % 5 = 3 THEN 'Bank2' ELSE 'Caja' END AS entidad,
       CASE l.l_suppkey % 5 WHEN 0 THEN 'Account' WHEN 1 THEN 'Card' WHEN 2 THEN 'Shared'
                            WHEN 3 THEN 'Account' ELSE 'Cash' END AS origen
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""

TRIMMED = r"regexp_replace({0}, '^[\s\x0b\p{{Z}}]+|[\s\x0b\p{{Z}}]+$', '', 'g')"


def hash_sql(fecha: str, concepto: str, importe: str) -> str:
    text = TRIMMED.format(concepto)
    return f"sha256(CAST({fecha} AS VARCHAR) || '-' || lower({text}) || '-' || printf('%.2f', {importe}))"


def literal(value) -> str:
    if value is None or isinstance(value, bool):
        return {None: "NULL", True: "true", False: "false"}[value]
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def values(rows, names: str) -> str:
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({names})"


MASTER = values(data.MASTER, "rule_id, keyword, priority, grupo_categoria, categoria, subcategoria, entity_name")
ENTITIES = values(data.ENTITIES, "rule_id, keyword, entity_name, priority")
CATEGORIES = values(data.CATEGORIES, "rule_id, keyword, category, priority")

PART_RULES = """
SELECT p_partkey AS rule_id,
       CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' ' || p_type
            WHEN 2 THEN split_part(p_name, ' ', 2) || ' ' || p_type ELSE p_type || ' ' || p_brand END AS keyword,
       p_size AS priority,
       CASE p_partkey % 5 WHEN 0 THEN 'Ingresos' WHEN 1 THEN 'Gastos Fijos' WHEN 2 THEN 'Gastos Variables'
            WHEN 3 THEN 'Movimientos Operativos' ELSE 'Ahorro e Inversión' END AS grupo_categoria,
       p_type AS categoria,
       CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS subcategoria,
       'Comercio ' || p_name AS entity_name
FROM part
"""

CTES = {
    "txn": TXN,
    "mov": f"SELECT {hash_sql('fecha', 'concepto', 'importe')} AS hash_id, * FROM txn",
    "master": MASTER,
    "part_rules": PART_RULES,
}


def with_ctes(names: str, sql: str, **extra: str) -> str:
    """``sql`` behind the named common tables, then the extra ones in order."""
    parts = [f"{n} AS ({CTES[n]})" for n in names.split()] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH {', '.join(parts)} {sql}"


def first_rule(rules: str) -> dict[str, str]:
    """Winning rule of every (concepto, s) pair of ``mov``, by nested comparison and ranking."""
    return {
        "needles": f"""
            SELECT *, strip_accents(upper(keyword)) AS needle,
                   CASE WHEN grupo_categoria = 'Ingresos' THEN 1 ELSE -1 END AS gate
            FROM {rules} WHERE trim(keyword) <> ''""",
        "texts": "SELECT DISTINCT concepto, CAST(sign(coalesce(importe, 0)) AS INTEGER) AS s, strip_accents(upper(concepto)) AS folded FROM mov",
        "best": """
            SELECT t.concepto, t.s, arg_min(n, (n.priority, n.rule_id)) AS r
            FROM texts t JOIN needles n ON contains(t.folded, n.needle) AND (t.s = 0 OR t.s = n.gate)
            GROUP BY t.concepto, t.s""",
        "classed": """
            SELECT m.*,
                   CASE WHEN b.concepto IS NOT NULL THEN b.r.grupo_categoria WHEN m.importe > 0 THEN 'Ingresos' ELSE 'Gastos Variables' END AS grupo,
                   CASE WHEN b.concepto IS NOT NULL THEN b.r.categoria WHEN m.importe > 0 THEN 'Otros Ingresos' ELSE 'Otros Gastos' END AS categoria,
                   CASE WHEN b.concepto IS NOT NULL THEN b.r.subcategoria ELSE 'Sin Clasificar' END AS subcategoria,
                   CASE WHEN b.concepto IS NOT NULL THEN b.r.entity_name ELSE 'Desconocido' END AS entity_name
            FROM mov m LEFT JOIN best b ON m.concepto = b.concepto AND sign(coalesce(m.importe, 0)) = b.s""",
    }


OPERATIONS = values(data.OPERATIONS, "place, label, bank, origin, pattern, amount, gift, moves")


def label_ctes(source: str) -> dict[str, str]:
    """``labelled``: the rows of ``source`` with their operation's label, and its ``gift`` and ``moves``."""
    return {
        "operations": OPERATIONS,
        "numbered": f"SELECT row_number() OVER () AS r, * FROM {source}",
        "named": """
            SELECT n.r, arg_min(o, o.place) AS o
            FROM numbered n JOIN operations o
              ON contains(upper(n.concepto), o.pattern) AND coalesce(o.bank, n.entidad) = n.entidad
             AND coalesce(o.origin, n.origen) = n.origen AND coalesce(o.amount, abs(n.importe)) = abs(n.importe)
            GROUP BY n.r""",
        "labelled": """
            SELECT n.* EXCLUDE (r), coalesce(w.o.label, 'Movimiento Regular') AS operativa_interna,
                   coalesce(w.o.gift, false) AS gift, coalesce(w.o.moves, true) AS moves,
                   n.origen = 'Shared' AND NOT coalesce(w.o.gift, false) AS es_compartido
            FROM numbered n LEFT JOIN named w USING (r)""",
    }


PERSONAL = "CASE WHEN gift THEN CAST(0 AS DOUBLE) WHEN es_compartido THEN importe / 2 ELSE importe END"
LABELLED = label_ctes("mov")

_DELIMS = r"\s\[\](){}/|\\<>!?@\x22^#$&~_,.:;*%+\-"


def initcap_sql(text: str) -> str:
    return (
        f"list_aggregate(list_transform(regexp_extract_all({text}, '([{_DELIMS}]+|[^{_DELIMS}]+)', 1), "
        "lambda t: upper(t[1:1]) || lower(t[2:])), 'string_agg', '')"
    )


DATE_PARTS = """
CAST(year({0}) AS INTEGER) AS anio, CAST(month({0}) AS INTEGER) AS mes,
strftime({0}, '%Y-%m') AS anio_mes, CAST(quarter({0}) AS INTEGER) AS trimestre
"""

SILVER = {
    **first_rule("master"),
    **label_ctes("classed"),
    "silver": f"""
        SELECT hash_id, fecha, {DATE_PARTS.format('fecha')}, concepto, importe, entidad, origen, operativa_interna,
               grupo, categoria, subcategoria,
               CASE WHEN entity_name = 'Desconocido' THEN {initcap_sql('concepto')} ELSE entity_name END AS comercio,
               es_compartido, {PERSONAL} AS importe_personal, moves AS es_movimiento_real
        FROM labelled""",
}
ADJUSTMENTS = {
    "settled": """
        SELECT hash_id, fecha FROM mov
        WHERE origen = 'Shared' AND contains(upper(concepto), 'CARGO TERRAZA') AND day(fecha) % 2 = 0""",
    "adjustments": """
        SELECT hash_id, month(fecha) * CAST(1.5 AS DOUBLE) AS adjustment_amount FROM settled
        UNION ALL SELECT hash_id, month(fecha) * CAST(1.5 AS DOUBLE) + 1 FROM settled WHERE day(fecha) = 2""",
}
# Halves what is left of a shared settlement once the adjustments of its identity are taken off.
ADJUSTED = f"""
if(b.operativa_interna = {literal(data.OPERATIONS[1][1])}, coalesce(-(abs(b.importe) - a.adjustment_amount) / 2, b.importe_personal),
   b.importe_personal)
"""
GOLD = {
    **SILVER, **ADJUSTMENTS,
    "gold": f"""
        SELECT b.* REPLACE ({ADJUSTED} AS importe_personal)
        FROM silver b LEFT JOIN adjustments a ON b.hash_id = a.hash_id""",
}

# What each level holds while nobody has classified a row.
OPEN_LEVELS = {
    "grupo": ("Sin Clasificar", "Gastos Variables"), "categoria": ("Otros Gastos",), "subcategoria": ("Sin Clasificar",),
}
PENDING = " AND ".join(
    f"coalesce({level}, '') IN ({', '.join(map(literal, ('', *names)))})" for level, names in OPEN_LEVELS.items())

AMOUNT_TEXT = """
CASE l_orderkey % 7 WHEN 0 THEN CAST(l_extendedprice AS VARCHAR)
     WHEN 1 THEN replace(CAST(l_extendedprice AS VARCHAR), '.', ',')
     WHEN 2 THEN th || '.' || rest || ',50' WHEN 3 THEN th || ',' || rest || '.25'
     WHEN 4 THEN ' -' || th || '.' || rest || ' ' WHEN 5 THEN th || '.' || rest || '.000'
     ELSE CAST(l_extendedprice AS VARCHAR) || ' EUR' END
"""
AMOUNTS = f"""
SELECT l_orderkey, {AMOUNT_TEXT} AS text FROM (
  SELECT *, CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS VARCHAR) AS th,
         lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0') AS rest
  FROM lineitem)
"""
DAYS = """
SELECT o_orderkey,
       CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y')
            WHEN 1 THEN day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate)
            WHEN 2 THEN '31/' || month(o_orderdate) || '/' || year(o_orderdate)
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS text
FROM orders
"""
CASH = f"""
SELECT {hash_sql('fecha', 'concepto', 'importe')} AS hash_id, fecha, concepto, importe, 'Caja' AS entidad, 'Cash' AS origen
FROM (SELECT try_cast(fecha AS DATE) AS fecha, concepto, CASE WHEN isfinite(try_cast(importe AS DOUBLE)) THEN try_cast(importe AS DOUBLE) END AS importe
      FROM (SELECT CASE WHEN day(fecha) = 31 THEN 'n/a' WHEN day(fecha) = 29 THEN CAST(year(fecha) AS VARCHAR) WHEN day(fecha) <> 30 THEN CAST(fecha AS VARCHAR) END AS fecha,
                   concepto,
                   CASE WHEN importe > 50000 THEN 'mucho' WHEN day(fecha) <= 5 THEN ['12d', 'NaN', 'inf', '1e400', '1f'][day(fecha)] WHEN importe > -50000 THEN CAST(importe AS VARCHAR) END AS importe
            FROM txn WHERE origen = 'Cash')
      WHERE fecha IS NOT NULL AND importe IS NOT NULL)
"""
ANSWERS = """
SELECT p_partkey, upper(p_name) AS keyword,
       CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE '?' END AS size,
       p_type, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS brand, p_name
FROM part
"""
SUGGESTIONS = """
SELECT DISTINCT keyword, coalesce(try_cast(size AS INTEGER), 50) AS priority, 'Gastos Fijos' AS grupo_categoria,
       p_type AS categoria, nullif(brand, '') AS subcategoria, 'Casa, ' || p_name AS entity_name
FROM answers
"""
TAXONOMY = "SELECT DISTINCT grupo_categoria, categoria, subcategoria FROM part_rules"
STATEMENT_FILES = "('Bank1', 'Account'), ('Bank1', 'Card'), ('Bank1', 'Shared'), ('Caja', 'Cash')"
STORED = "SELECT * FROM mov WHERE fecha < DATE '1997-01-01'"
BATCH = "SELECT * FROM mov WHERE fecha >= DATE '1996-07-01'"
UNIQUE = "SELECT count(*) FROM (SELECT hash_id FROM {0} WHERE hash_id IS NOT NULL GROUP BY hash_id HAVING count(*) > 1)"
NULLS = "SELECT count(*) FROM {0} WHERE {1} IS NULL"


def _slice(name: str) -> str:
    entidad, origen = data.SLICES[name]
    return f"(SELECT * FROM mov WHERE entidad = '{entidad}' AND origen = '{origen}')"


def _suite() -> str:
    parts = []
    for name in ("account", "card", "shared", "app_account", "cash", "fct_transactions"):
        source = {"cash": "cash", "fct_transactions": "mov"}.get(name) or _slice(name)
        parts.append(f"SELECT '{name}' AS \"table\", 'hash_id' AS \"column\", 'unique' AS kind, ({UNIQUE.format(source)}) AS failures")
        parts.append(f"SELECT '{name}', 'hash_id', 'not_null', ({NULLS.format(source, 'hash_id')})")
    parts.append(f"SELECT 'cash', 'importe', 'not_null', ({NULLS.format('cash', 'importe')})")
    return " UNION ALL ".join(parts)


def _lookup(rules: str, value: str, fallback: str, out: str) -> str:
    return with_ctes("txn mov", f"""
        SELECT m.hash_id, m.concepto, CASE WHEN b.concepto IS NULL THEN {fallback} ELSE b.v END AS {out}
        FROM mov m LEFT JOIN best b ON m.concepto = b.concepto""",
        r=rules, best=f"""
        SELECT t.concepto, arg_min(r.{value}, (r.priority, r.rule_id)) AS v
        FROM (SELECT DISTINCT concepto FROM mov) t JOIN r ON contains(upper(t.concepto), upper(r.keyword))
        GROUP BY t.concepto""")


_CLASS = "SELECT hash_id, importe, grupo, categoria, subcategoria, entity_name FROM classed"

ORACLE = {
    "scan_bronze": with_ctes("txn mov", "SELECT * FROM mov"),
    "union_sources": with_ctes("txn mov", " UNION ALL ".join(f"SELECT * FROM {_slice(n)}" for n in data.SLICES)),
    "hash_identity": with_ctes("txn mov", "SELECT hash_id, fecha, concepto, importe FROM mov"),
    "money_text": """
        SELECT l_orderkey, x, printf('%.2f', x) AS text FROM (
          SELECT l_orderkey, CASE WHEN l_orderkey % 2 = 0 THEN l_quantity * CAST(0.125 AS DOUBLE)
                                  ELSE l_quantity * l_discount * CAST(-0.5 AS DOUBLE) END AS x FROM lineitem)""",
    "cash_normalize": with_ctes("txn", CASH),
    "amount_parse": f"""
        SELECT l_orderkey, text, try_cast(CASE WHEN contains(t, ',') AND contains(t, '.') THEN replace(replace(t, '.', ''), ',', '.')
               WHEN contains(t, ',') THEN replace(t, ',', '.') ELSE t END AS DOUBLE) AS importe
        FROM (SELECT *, trim(text) AS t FROM ({AMOUNTS}))""",
    "number_parse": f"SELECT l_orderkey, text, try_cast(trim(text) AS DOUBLE) AS importe FROM ({AMOUNTS})",
    "date_parse": f"""
        SELECT o_orderkey, text, CAST(try_strptime(text, '%d/%m/%Y') AS DATE) AS by_day,
               CAST(try_strptime(text, '%Y-%m-%d %H:%M:%S') AS DATE) AS by_stamp FROM ({DAYS})""",
    "date_infer": f"""
        SELECT o_orderkey, text, CAST(coalesce(try_strptime(text, '%Y-%m-%d %H:%M:%S'), try_strptime(text, '%d/%m/%Y')) AS DATE) AS fecha
        FROM ({DAYS})""",
    "capitalize_names": """
        SELECT c_custkey, upper(n[1:1]) || lower(n[2:]) AS entidad
        FROM (SELECT c_custkey, c_mktsegment || ' ' || c_name AS n FROM customer)""",
    "initcap_text": f"SELECT doc_id, {initcap_sql('t')} AS title FROM (SELECT doc_id, replace(text, 'ß', 'ss') AS t FROM documents)",
    "accent_fold": "SELECT doc_id, strip_accents(upper(replace(text, 'ß', 'ss'))) AS folded FROM documents",
    "trim_unicode": "SELECT p_partkey, p_name || ' ' || chr(8195) || ' ' || p_type AS text FROM part",
    "file_parts": """
        SELECT doc_id, 'doc_' || doc_id || e AS name,
               'doc_' || doc_id || CASE doc_id % 4 WHEN 1 THEN '.tar' ELSE '' END AS stem,
               CASE doc_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.xlsx' WHEN 2 THEN '' ELSE '.csv2' END AS suffix,
               doc_id % 4 IN (0, 3) AS is_csv
        FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '.CSV' WHEN 1 THEN '.tar.Xlsx' WHEN 2 THEN '' ELSE '.csv2' END AS e FROM documents)""",
    "rename_project": """
        SELECT CAST(o_orderdate AS DATE) AS fecha, o_orderpriority AS concepto, o_totalprice AS importe, 'Banco' AS entidad FROM orders""",
    "drop_null_critical": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha, o_orderpriority AS concepto, o_totalprice AS importe
        FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0""",
    "split_packed_parts": """
        SELECT p_partkey, s[1] AS part_0, s[2] AS part_1, s[3] AS part_2, s[4] AS part_3, s[5] AS part_4
        FROM (SELECT p_partkey, string_split(CASE WHEN p_partkey % 3 = 0 THEN p_brand
                                             ELSE p_brand || '|' || p_type || '||' || p_name END, '|') AS s FROM part)""",
    "date_dims": f"SELECT o_orderkey, {DATE_PARTS.format('o_orderdate')} FROM orders",
    "csv_statement": with_ctes("txn", f"""
        SELECT {hash_sql('fecha', 'concepto', 'importe')} AS hash_id, * FROM (
          SELECT CAST(fecha AS VARCHAR) AS fecha, concepto || ', "x"' AS concepto, importe, entidad, origen,
                 upper(entidad) AS bank, upper(origen) AS account,
                 '/in/' || upper(entidad) || '/' || upper(origen) || '/all.csv' AS path
          FROM txn WHERE (entidad, origen) IN ({STATEMENT_FILES}))"""),
    "statement_report": with_ctes("txn", f"""
        SELECT '/in/' || upper(entidad) || '/' || upper(origen) || '/all.csv' AS path, upper(entidad) AS bank,
               upper(origen) AS account, 'loaded' AS status, count(*) AS n_rows
        FROM txn WHERE (entidad, origen) IN ({STATEMENT_FILES}) GROUP BY ALL"""),
    "statement_defects": with_ctes("txn", f"""
        SELECT path, bank, account,
               CASE account WHEN 'ACCOUNT' THEN 'missing_columns' WHEN 'CARD' THEN 'ragged_rows'
                            WHEN 'SHARED' THEN 'unclosed_quote' ELSE 'loaded' END AS status,
               CASE account WHEN 'CASH' THEN n ELSE 0 END AS n_rows
        FROM (SELECT '/in/' || upper(entidad) || '/' || upper(origen) || '/all.csv' AS path, upper(entidad) AS bank,
                     upper(origen) AS account, count(*) AS n
              FROM txn WHERE (entidad, origen) IN ({STATEMENT_FILES}) GROUP BY ALL)"""),
    "positional_statement": with_ctes("txn", f"""
        SELECT {hash_sql('fecha', 'concepto', 'importe')} AS hash_id, * FROM (
          SELECT CAST(fecha AS VARCHAR) AS fecha, concepto || ', "x"' AS concepto, importe, 'banco uno' AS entidad,
                 'tarjeta' AS origen, 'BANK1' AS bank, 'CARD' AS account, '/in/BANK1/CARD/all.csv' AS path
          FROM txn WHERE origen = 'Card')"""),
    "statement_files": with_ctes("txn", f"""
        SELECT {hash_sql('fecha', 'concepto', 'importe')} AS hash_id, * FROM (
          SELECT CAST(fecha AS VARCHAR) AS fecha,
                 concepto || CASE WHEN day(fecha) = 7 THEN ',' || chr(10) || ' "x"' ELSE ', "x"' END AS concepto,
                 importe, entidad, origen, upper(entidad) AS bank, upper(origen) AS account
          FROM txn WHERE (entidad, origen) IN ({STATEMENT_FILES}))"""),
    "date_election": """
        WITH t AS (
          SELECT o_orderkey, o_custkey % 40 AS grp, CAST(o_orderdate AS DATE) AS day FROM orders
        ), s AS (
          SELECT o_orderkey, grp, CASE grp % 5 WHEN 0 THEN strftime(day, '%d/%m/%Y') WHEN 1 THEN strftime(day, '%m/%d/%Y')
                 WHEN 2 THEN strftime(day, '%Y-%m-%d') WHEN 3 THEN (day(day) % 12 + 1) || '/' || month(day) || '/' || year(day)
                 ELSE CASE WHEN o_orderkey % 3 = 0 THEN strftime(day, '%Y-%m-%d') ELSE strftime(day, '%d/%m/%Y') END END AS text
          FROM t
        ), p AS (
          SELECT *, CAST(try_strptime(text, '%Y-%m-%d') AS DATE) AS iso, CAST(try_strptime(text, '%m/%d/%Y') AS DATE) AS md,
                 CAST(try_strptime(text, '%d/%m/%Y') AS DATE) AS dm FROM s
        ), e AS (
          SELECT grp, greatest(count(iso), count(md), count(dm)) AS n,
                 CASE WHEN count(iso) = n THEN '%Y-%m-%d' WHEN count(md) = n THEN '%m/%d/%Y' ELSE '%d/%m/%Y' END AS date_format,
                 count(md) = n AND count(dm) = n AND count(*) FILTER (md <> dm) > 0 AS ambiguous
          FROM p GROUP BY grp
        )
        SELECT o_orderkey, grp, text, date_format, ambiguous,
               CASE date_format WHEN '%Y-%m-%d' THEN iso WHEN '%m/%d/%Y' THEN md ELSE dm END AS fecha
        FROM p JOIN e USING (grp)""",
    "config_explode": """
        SELECT 'BANK_' || s_suppkey AS bank, 'ACCOUNT' AS account, CAST(s_suppkey % 9 AS INTEGER) AS skip_rows, 0 AS skip_footer,
               'FECHA,IMPORTE ' || (s_suppkey % 3) AS column_mapping, '%d/%m/%Y' AS date_format, CAST(NULL AS BOOLEAN) AS filter_completed
        FROM supplier
        UNION ALL SELECT 'BANK_' || s_suppkey, 'CARD', 4, NULL, 'A', NULL, true FROM supplier""",
    "config_semi_join": """
        SELECT c_custkey, bank, account
        FROM (SELECT c_custkey, 'BANK_' || c_nationkey AS bank, CASE WHEN c_custkey % 4 = 0 THEN 'CARD' ELSE 'ACCOUNT' END AS account FROM customer) f
        WHERE EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 3 = 0 AND 'BANK_' || s_nationkey = f.bank AND f.account = 'ACCOUNT')""",
    "ingest_metrics": with_ctes("txn", """
        SELECT bank, account, count(DISTINCT (bank, account, path)) AS n_files, count(*) AS n_rows
        FROM (SELECT entidad AS bank, origen AS account, strftime(fecha, '%Y-%m') AS path FROM txn)
        GROUP BY ROLLUP (bank, account)"""),
    "rules_prepare": with_ctes("part_rules", """
        SELECT rule_id, priority, strip_accents(upper(keyword)) AS needle,
               CASE WHEN grupo_categoria = 'Ingresos' THEN 1 ELSE -1 END AS gate, entity_name FROM part_rules"""),
    "classify_rules": with_ctes("txn mov master", _CLASS, **first_rule("master")),
    "classify_one_pass": with_ctes("txn mov master", _CLASS, **first_rule("master")),
    "classify_part_rules": with_ctes("txn mov part_rules", _CLASS, **first_rule("part_rules")),
    "classify_anchored": with_ctes("txn mov part_rules", _CLASS, **first_rule("part_rules")),
    "classify_fallback": with_ctes("txn", """
        SELECT fecha, concepto, importe, CASE WHEN importe > 0 THEN 'Ingresos' ELSE 'Gastos Variables' END AS grupo,
               CASE WHEN importe > 0 THEN 'Otros Ingresos' ELSE 'Otros Gastos' END AS categoria,
               'Sin Clasificar' AS subcategoria, 'Desconocido' AS entity_name FROM txn"""),
    "standardize_entity": _lookup(ENTITIES, "entity_name", "upper(m.concepto)", "entity"),
    "map_category": _lookup(CATEGORIES, "category", "'Otros'", "category"),
    "rule_conflicts": with_ctes("part_rules", """
        SELECT b.rule_id, b.needle, b.priority, w.rule_id AS shadowed_by, w.priority = b.priority AS tied
        FROM (SELECT b.rule_id, b.needle, b.priority, arg_min(a, (a.priority, a.rule_id)) AS w
              FROM n b JOIN n a ON contains(b.needle, a.needle) AND a.gate = b.gate
              GROUP BY b.rule_id, b.needle, b.priority) b
        WHERE w.rule_id <> b.rule_id""",
        n="SELECT *, strip_accents(upper(keyword)) AS needle, grupo_categoria = 'Ingresos' AS gate FROM part_rules"),
    "category_taxonomy": with_ctes("part_rules", TAXONOMY),
    "ragged_pad": """
        SELECT conv_id, turn, list_aggregate(list_resize(string_split(text, ' '), 8, ''), 'string_agg', '|') AS cells, 8 AS width
        FROM conversations""",
    "sync_rules": """
        SELECT p_partkey, p_name AS keyword,
               CASE WHEN p_partkey % 3 = 0 OR p_partkey % 5 = 0 THEN 50 ELSE p_size END AS priority,
               CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS grupo_categoria,
               CASE WHEN p_partkey % 3 = 2 THEN p_brand ELSE '' END AS categoria
        FROM part""",
    "fence_strip": f"""
        SELECT p_partkey, 'keyword,priority,grupo_categoria,categoria,subcategoria,entity_name' || chr(10) || keyword || ',' || size
               || ',Gastos Fijos,' || p_type || ',' || brand || ',"Casa, ' || p_name || '"' AS text FROM ({ANSWERS})""",
    "suggestions_clean": with_ctes("", SUGGESTIONS, answers=ANSWERS),
    "suggestions_check": with_ctes("part_rules", """
        SELECT s.*, EXISTS (SELECT 1 FROM taxonomy t WHERE t.grupo_categoria = s.grupo_categoria AND t.categoria = s.categoria
                            AND t.subcategoria IS NOT DISTINCT FROM s.subcategoria) AS known FROM suggestions s""",
        answers=ANSWERS, suggestions=SUGGESTIONS, taxonomy=TAXONOMY),
    "internal_operation": with_ctes(
        "txn", "SELECT * EXCLUDE (gift, moves, es_compartido) FROM labelled", **label_ctes("txn")),
    "shared_flag": with_ctes("txn mov", "SELECT hash_id, origen, operativa_interna, es_compartido FROM labelled", **LABELLED),
    "personal_amount": with_ctes("txn mov", f"SELECT hash_id, importe, {PERSONAL} AS importe_personal FROM labelled", **LABELLED),
    "real_movement_flag": with_ctes("txn mov", "SELECT hash_id, operativa_interna, moves AS es_movimiento_real FROM labelled", **LABELLED),
    "incremental_new_rows": with_ctes("txn mov", "SELECT * FROM batch WHERE hash_id NOT IN (SELECT hash_id FROM stored)", stored=STORED, batch=BATCH),
    "incremental_salted": with_ctes("txn mov", "SELECT * FROM batch WHERE hash_id NOT IN (SELECT hash_id FROM stored)", stored=STORED, batch=BATCH),
    "not_in_null_semantics": with_ctes("txn mov", " UNION ALL ".join(
        f"SELECT '{name}' AS stored, hash_id, fecha, concepto, importe FROM b WHERE hash_id NOT IN (SELECT hash_id FROM {source})"
        for name, source in (("none_stored", "(SELECT * FROM stored WHERE false)"), ("no_null_stored", "stored"), ("null_stored", "holed"))),
        stored=STORED, batch=BATCH,
        b="SELECT * REPLACE (CASE WHEN importe <> 0 THEN hash_id END AS hash_id) FROM batch",
        holed="SELECT * REPLACE (CASE WHEN importe <> 320 THEN hash_id END AS hash_id) FROM stored"),
    "upsert_by_key": with_ctes("txn mov", """
        SELECT * REPLACE ('antes' AS entidad) FROM stored s WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.hash_id = s.hash_id)
        UNION ALL SELECT * FROM batch""", stored=STORED, batch=BATCH),
    "incremental_table": with_ctes("txn mov", """
        SELECT *, strftime(fecha, '%Y-%m') AS anio_mes FROM (
          SELECT * FROM stored UNION ALL SELECT * FROM batch WHERE hash_id NOT IN (SELECT hash_id FROM stored))""",
        stored=STORED, batch=BATCH),
    "upsert_table": with_ctes("txn mov", """
        SELECT *, strftime(fecha, '%Y-%m') AS anio_mes FROM (
          SELECT * REPLACE ('antes' AS entidad) FROM stored s WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.hash_id = s.hash_id)
          UNION ALL SELECT * FROM batch)""", stored=STORED, batch=BATCH),
    "schema_sync": with_ctes("txn mov", """
        SELECT * REPLACE (CAST(NULL AS VARCHAR) AS origen) FROM stored UNION ALL SELECT * FROM batch""", stored=STORED, batch=BATCH),
    "merchant_name": with_ctes("txn mov master", "SELECT hash_id, concepto, comercio FROM silver", **SILVER),
    "silver_transactions": with_ctes("txn mov master", "SELECT * FROM silver", **SILVER),
    "gold_adjustment": with_ctes("txn mov", f"""
        SELECT b.hash_id, b.importe, b.operativa_interna, {ADJUSTED} AS importe_personal
        FROM (SELECT *, {PERSONAL} AS importe_personal FROM labelled) b LEFT JOIN adjustments a ON b.hash_id = a.hash_id""",
        **LABELLED, **ADJUSTMENTS),
    "gold_transactions": with_ctes("txn mov master", "SELECT * FROM gold", **GOLD),
    "monthly_spend": with_ctes("txn mov master", """
        SELECT anio_mes, grupo, categoria, CAST(sum(CAST(importe_personal AS DECIMAL(18,4))) AS DOUBLE) AS total, count(*) AS n_rows
        FROM gold WHERE es_movimiento_real GROUP BY ALL""", **GOLD),
    "spend_rollup": with_ctes("txn mov master", """
        SELECT grupo, categoria, subcategoria,
               3 - CAST(grouping(grupo) + grouping(categoria) + grouping(subcategoria) AS INTEGER) AS level,
               CAST(sum(CAST(importe_personal AS DECIMAL(18,4))) AS DOUBLE) AS total, count(*) AS n_rows
        FROM gold WHERE es_movimiento_real GROUP BY ROLLUP (grupo, categoria, subcategoria)""", **GOLD),
    "unclassified_concepts": with_ctes("txn mov master", f"SELECT DISTINCT concepto FROM silver WHERE {PENDING} ORDER BY concepto LIMIT 20", **SILVER),
    "unclassified_by_weight": with_ctes("txn mov master", f"""
        SELECT concepto, count(*) AS n_rows, CAST(sum(CAST(abs(importe) AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM silver WHERE {PENDING} GROUP BY concepto""", **SILVER),
    "dq_unique": with_ctes("txn mov", "SELECT hash_id, count(*) AS n_rows FROM mov GROUP BY hash_id HAVING count(*) > 1"),
    "dq_unique_texts": with_ctes("txn mov", "SELECT concepto, count(*) AS n_rows FROM mov GROUP BY concepto HAVING count(*) > 1"),
    "dq_not_null": with_ctes("txn", """
        SELECT count(*) FILTER (hash_id IS NULL) AS hash_id, count(*) FILTER (fecha IS NULL) AS fecha,
               count(*) FILTER (concepto IS NULL) AS concepto, count(*) FILTER (importe IS NULL) AS importe,
               count(*) FILTER (entidad IS NULL) AS entidad, count(*) FILTER (origen IS NULL) AS origen FROM cash""", cash=CASH),
    "dq_suite": with_ctes("txn mov", _suite(), cash=CASH),
}

# Through files and tables the same rows come out.
ORACLE |= {
    "landing_zone": ORACLE["scan_bronze"],
    "cash_files": ORACLE["cash_normalize"],
    "seed_files": ORACLE["rules_prepare"],
    "lakehouse_totals": ORACLE["monthly_spend"],
}
