"""Code tables over the sample tables, in SQL that Spark and the checker share.

The sample tables hold no classification codes, so parts play codes, line items
play visits, regions and nations play chapters and sections, documents play the
described code list and events play the flattened export. Every view reads its
tables in full. Every part has a code of its own, whatever their number.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_DIGITS = "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ'"


def _digit(value: str, place: int) -> str:
    """A digit of a number to base 36."""
    return f"substr({_DIGITS}, cast(floor({value} / {36**place}) % 36 AS int) + 1, 1)"


def _digits(value: str, most: int) -> str:
    """A number to base 36 without leading zeros; nothing for 0."""
    return " || ".join(f"CASE WHEN {value} >= {36**p} THEN {_digit(value, p)} ELSE '' END" for p in reversed(range(most)))


# A letter, the size, and three digits to base 36 tell 46,656 parts of a size apart; each next such block of parts has
# other letters, and after eight blocks codes get further digits at their end.
_BLOCK = "floor(p_partkey / 46656)"
_PART_CODES = f"""
SELECT p_partkey, p_size, p_type, p_name, p_brand,
       substr('PQRABCDEFGHIJKLMNOSTUVWX', cast(p_partkey % 3 + 3 * ({_BLOCK} % 8) AS int) + 1, 1)
           || lpad(cast(p_size AS string), 2, '0') || '.'
           || {_digit("p_partkey", 2)} || {_digit("p_partkey", 1)} || {_digit("p_partkey", 0)}
           || {_digits("floor(p_partkey / 373248)", 4)} AS code
FROM {{part}}
"""

# A letter per language; two of them begin alike.
_LETTER = "CASE lang WHEN 'es' THEN 'S' ELSE upper(substr(lang, 1, 1)) END"
_SOURCE = "lpad(substr(source, 4), 2, '0')"

_SIZE_TEXT = "'Parts of size ' || cast(p_size AS string)"

VIEWS = {
    # One row per line item: the code of its part, the customer, the day.
    "visits": f"""
SELECT p.code AS field, o_custkey AS custkey, cast(l_shipdate AS date) AS day,
       cast(year(o_orderdate) AS int) AS year
FROM {{lineitem}}
JOIN ({_PART_CODES}) p ON l_partkey = p.p_partkey
JOIN {{orders}} ON l_orderkey = o_orderkey
""",
    # The codes alone, where nothing else of the visit is asked for.
    "visit_codes": f"""
SELECT p.code AS field
FROM {{lineitem}}
JOIN ({_PART_CODES}) p ON l_partkey = p.p_partkey
""",
    # The same codes with a letter per kind of part.
    "visits_by_type": f"""
SELECT substr(p.p_type, 1, 1) || substr(p.code, 2) AS field
FROM {{lineitem}}
JOIN ({_PART_CODES}) p ON l_partkey = p.p_partkey
""",
    # Codes of the parts shipped in a year. The kind of part decides how deep a
    # code is described; STANDARD parts and some PROMO parts lack ancestors.
    "nodes": f"""
SELECT year, max(depth) AS depth, code, min(title) AS title
FROM (
  SELECT s.year, b.* FROM (
    SELECT p_partkey, 1 AS depth, substr(code, 1, 3) AS code, {_SIZE_TEXT} AS title
    FROM ({_PART_CODES}) c WHERE p_type <> 'STANDARD'
    UNION ALL
    SELECT p_partkey, 2, substr(code, 1, 5), {_SIZE_TEXT} || ', ' || p_type
    FROM ({_PART_CODES}) c WHERE p_type <> 'STANDARD'
    UNION ALL
    SELECT p_partkey, 3, substr(code, 1, 6),
           {_SIZE_TEXT} || ' ' || p_type || ' ' || p_name || CASE WHEN p_type = 'MEDIUM' THEN ',' ELSE '' END
    FROM ({_PART_CODES}) c WHERE p_type NOT IN ('STANDARD', 'LARGE')
    UNION ALL
    SELECT p_partkey, CASE WHEN p_type = 'STANDARD' AND p_brand = 'Brand#25' THEN 3 ELSE 4 END, code,
           CASE WHEN p_type = 'SMALL' THEN 'Pièce ' ELSE '' END || p_type || ' ' || p_name || ' ' || p_brand
    FROM ({_PART_CODES}) c
    WHERE p_type IN ('MEDIUM', 'SMALL', 'STANDARD') OR (p_type = 'PROMO' AND p_brand <> 'Brand#1')
    UNION ALL
    SELECT p_partkey, 5, code || substr(p_brand, length(p_brand), 1), 'Explicit ' || p_name || ' ' || p_brand
    FROM ({_PART_CODES}) c WHERE p_type = 'PROMO'
  ) b
  JOIN (SELECT DISTINCT cast(year(l_shipdate) AS int) AS year, l_partkey FROM {{lineitem}}) s
    ON b.p_partkey = s.l_partkey
) n
GROUP BY year, code
""",
    # Regions and nations that ordered in a year, as chapters and sections.
    "chapters": """
SELECT DISTINCT cast(year(o_orderdate) AS int) AS year, r_regionkey AS ord,
       r_name || CASE WHEN r_name = 'MIDDLE EAST' THEN ' (P45-P45)'
                 ELSE ' (P' || lpad(cast(10 * r_regionkey AS string), 2, '0') || '-P'
                            || lpad(cast(10 * r_regionkey + 9 AS string), 2, '0') || ')' END AS title
FROM {orders}
JOIN {customer} ON o_custkey = c_custkey
JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
""",
    "sections": """
SELECT DISTINCT cast(year(o_orderdate) AS int) AS year, n_nationkey AS ord,
       'P' || lpad(cast(2 * n_nationkey AS string), 2, '0') AS low,
       'P' || lpad(cast(2 * n_nationkey + 2 AS string), 2, '0') AS high,
       n_name || ' (misc) goods (P' || lpad(cast(2 * n_nationkey AS string), 2, '0') || '-P'
              || lpad(cast(2 * n_nationkey + 2 AS string), 2, '0') || ')' AS title
FROM {orders}
JOIN {customer} ON o_custkey = c_custkey
JOIN {nation} ON c_nationkey = n_nationkey
""",
    # Return flags seen for a part in a year are its 7th characters.
    "rules": f"""
SELECT s.year, c.p_partkey AS ord, c.code AS name,
       CASE c.p_brand
         WHEN 'Brand#3' THEN 'The appropriate 7th character is to be added to each code from subcategory '
                             || substr(c.code, 1, 5) || ' and O30.1'
         WHEN 'Brand#5' THEN 'One of the following 7th characters is to be assigned to codes in subcategory '
                             || substr(c.code, 1, 6) || '-, ' || substr(c.code, 1, 6) || '.'
         WHEN 'Brand#7' THEN 'The appropriate 7th character is to be added to each code from category '
                             || substr(c.code, 1, 3) || ':'
         WHEN 'Brand#9' THEN 'to be added to all codes from subcategories S12.0-S12.6, ' || c.code
         WHEN 'Brand#11' THEN 'to be added to each code from category P01, M1A'
         WHEN 'Brand#13' THEN NULL
         ELSE 'No further character applies'
       END AS note,
       s.l_returnflag AS chr,
       CASE s.l_returnflag WHEN 'A' THEN 'Accepté' WHEN 'R' THEN 'Returned Later' ELSE 'None' END AS txt
FROM (SELECT DISTINCT cast(year(l_shipdate) AS int) AS year, l_partkey, l_returnflag FROM {{lineitem}}) s
JOIN ({_PART_CODES}) c ON s.l_partkey = c.p_partkey
""",
    # Documents as a described code list: language, source, number, last character.
    "listing": f"""
SELECT {_LETTER} || {_SOURCE} || lpad(cast(doc_id % 1000 AS string), 3, '0')
         || CASE n_chars % 4 WHEN 0 THEN '' WHEN 1 THEN 'A' WHEN 2 THEN 'D' ELSE 'S' END AS original,
       text AS description, doc_id
FROM {{documents}}
""",
    # Languages, tens of sources and sources as the category list.
    "categories": f"""
SELECT DISTINCT 1000 + ascii({_LETTER}) AS ord, {_LETTER} || '00-' || {_LETTER} || '99' AS code,
       CASE lang WHEN 'de' THEN 'IV' WHEN 'en' THEN 'V' WHEN 'es' THEN 'XIX' ELSE 'VI' END
         || '. texts and notes in ' || lang AS title
FROM {{documents}}
UNION ALL
SELECT DISTINCT 2000 + ascii({_LETTER}),
       {_LETTER} || substr({_SOURCE}, 1, 1) || '0-' || {_LETTER} || substr({_SOURCE}, 1, 1) || '9',
       lang || ' group ' || substr({_SOURCE}, 1, 1)
FROM {{documents}}
UNION ALL
SELECT DISTINCT 3000 + ascii({_LETTER}), {_LETTER} || {_SOURCE}, lang || ' from ' || source
FROM {{documents}}
""",
    # Events as lines of a flattened export: one value per line, some lines empty.
    "export": """
SELECT event_id AS row_id,
       CASE WHEN user_id % 16 = 0 THEN cast(user_id % 4000 AS string) END AS name0,
       CASE WHEN user_id % 16 = 1 THEN event_type || ' chapter' END AS desc0,
       CASE WHEN user_id % 16 = 2 THEN 'R' || cast(user_id AS string) END AS id6,
       CASE WHEN user_id % 16 = 3 THEN event_type || ' region' END AS desc7,
       CASE WHEN user_id % 16 = 4 THEN 'C' || cast(user_id AS string) END AS name8,
       CASE WHEN user_id % 16 = 5 THEN event_type || ' three' END AS desc9,
       CASE WHEN user_id % 16 = 6 THEN 'C' || cast(user_id AS string) || '.1' END AS name10,
       CASE WHEN user_id % 16 = 7 THEN event_type || ' five' END AS desc11,
       CASE WHEN user_id % 16 = 8 THEN 'C' || cast(user_id AS string) || '.12' END AS name14,
       CASE WHEN user_id % 16 = 9 THEN event_type || ' six' END AS desc15,
       CASE WHEN user_id % 16 = 10 THEN 'C' || cast(user_id AS string) || '.123' END AS name20,
       CASE WHEN user_id % 16 = 11 THEN event_type || ' seven' END AS desc21,
       CASE WHEN user_id % 16 = 12 THEN 'C' || cast(user_id AS string) || '.1234' END AS name23,
       CASE WHEN user_id % 16 = 13 THEN event_type || ' eight' END AS desc24
FROM {events}
""",
}

_STEP = "(user_id + event_id) % 20"
_TURN = "cast(floor(event_id / 60) AS bigint) % 3"
_CODE3 = "'C' || lpad(cast(cast(floor(event_id / 97) AS bigint) % 100 AS string), 2, '0')"


def _at(step: int, value: str, name: str, more: str = "") -> str:
    return f"       CASE WHEN {_STEP} = {step}{more} THEN {value} END AS {name}"


VIEWS |= {
    # An export with notes, characters and regions as well, and codes that the notes mention.
    "export_full": "SELECT event_id AS row_id,\n"
    + ",\n".join(
        [
            _at(0, "cast(user_id AS string)", "name0"),
            _at(1, "event_type || ' chapter'", "desc0"),
            f"       CASE WHEN {_STEP} = 2 THEN 'R' || cast(user_id % 9 AS string) WHEN {_STEP} = 18 THEN {_CODE3} || '.1' END AS id6",
            _at(3, "event_type || ' region'", "desc7"),
            _at(4, _CODE3, "name8"),
            _at(5, "event_type || ' three'", "desc9"),
            _at(6, f"{_CODE3} || '.1'", "name10"),
            _at(7, "event_type || ' five'", "desc11"),
            _at(8, f"{_CODE3} || '.12'", "name14"),
            _at(9, "event_type || ' six'", "desc15"),
            _at(10, f"{_CODE3} || '.123'", "name20"),
            _at(11, "event_type || ' seven'", "desc21"),
            _at(12, f"{_CODE3} || '.1234'", "name23"),
            _at(13, "event_type || ' eight'", "desc24"),
            _at(14, f"'to be added to each code from category ' || {_CODE3} || ':'", "note32", f" AND {_TURN} = 0"),
            _at(14, f"'added to subcategories ' || {_CODE3} || '.1, O30 and ' || {_CODE3}", "note42", f" AND {_TURN} = 1"),
            _at(14, f"'add to ' || {_CODE3} || '.12.'", "note58", f" AND {_TURN} = 2"),
            f"       CASE WHEN {_STEP} = 15 AND {_TURN} = 0 OR {_STEP} = 18 THEN event_type || ' first' END AS extension",
            _at(15, "'Séquelle ' || event_type", "extension43", f" AND {_TURN} = 1"),
            _at(15, "event_type", "extension59", f" AND {_TURN} = 2"),
            f"       CASE WHEN {_STEP} = 15 AND {_TURN} = 0 OR {_STEP} = 18 THEN 'A' END AS char0",
            _at(15, "'S'", "char44", f" AND {_TURN} = 1"),
            _at(15, "'D'", "char60", f" AND {_TURN} = 2"),
            _at(17, "event_type || ' area'", "sectionRef"),
            _at(17, "'C00'", "first0"),
            _at(17, "'C' || cast(user_id % 2 AS string) || '9'", "last0"),
            _at(17, "'R' || cast(user_id % 9 AS string)", "id0"),
        ]
    )
    + "\nFROM {events}",
    # Events as texts full of characters that patterns give a meaning.
    "signs": """
SELECT event_id, user_id,
       event_type || ' (' || cast(user_id AS string) || ') ' || props || ' a.' || cast(event_id % 7 AS string) || '* +'
         || cast(event_id % 5 AS string) || ' [' || cast(event_id % 3 AS string) || CASE WHEN event_id % 4 = 0 THEN '' ELSE '] $^|' END AS body
FROM {events}
""",
    # An order and its lines, for documents and element trees.
    "order_lines": """
SELECT o_custkey AS custkey, o_orderkey AS orderkey, o_orderstatus AS status, o_orderpriority AS priority,
       l_linenumber AS line, cast(l_quantity AS int) AS quantity, l_returnflag AS flag, l_linestatus AS linestatus, l_partkey AS partkey
FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey
""",
}

# Column names that SQL reserves or that differ from the operators' names.
_RENAMED = {
    "nodes": {"title": "desc"},
    "chapters": {"title": "desc"},
    "sections": {"title": "desc"},
    "rules": {"chr": "char", "txt": "text"},
    "categories": {"title": "description"},
    "export": {"row_id": "row", "name0": "name", "desc0": "desc"},
    "export_full": {
        "row_id": "row", "name0": "name", "desc0": "desc", "char0": "char", "first0": "first", "last0": "last", "id0": "id",
    },
}


@lru_cache(maxsize=128)
def _table(spark: SparkSession, path: str) -> DataFrame:
    """The schema of a table is read once per session."""
    return spark.read.parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a lazy DataFrame over the parquet tables in ``sf_dir``."""
    sql = VIEWS[name]
    tables = {t: _table(spark, f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **tables).withColumnsRenamed(_RENAMED.get(name, {}))
