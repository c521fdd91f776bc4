"""Queries on rules, names, classification axes and document headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query, sql_rows
from ..functions import strings
from ..operators import classify, registry
from ..operators.rules import first_failure
from ..session import table


@query("FIL-9", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'negative balance' WHEN c_mktsegment = 'BUILDING' THEN 'building' ELSE 'ok' END AS message FROM customer")
def first_failure_customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", first_failure([(F.col("c_acctbal") < 0, "negative balance"), (F.col("c_mktsegment") == "BUILDING", "building")]).alias("message"))


@query("FIL-4 FIL-5 FIL-6 FIL-9", "SELECT p_partkey, CASE WHEN NOT regexp_full_match(n, '[a-z0-9-]+') THEN 'charset' WHEN starts_with(n, '-') OR ends_with(n, '-') OR contains(n, '--') THEN 'hyphens' WHEN length(n) > 10 THEN 'length' ELSE 'ok' END AS message FROM (SELECT p_partkey, replace(p_name, ' ', '-') AS n FROM part)")
def name_rules(spark, sf):
    n = F.col("n")
    p = table(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("-")).alias("n"))
    return p.select("p_partkey", first_failure([(~n.rlike(r"\A[a-z0-9-]+\z"), "charset"), (n.startswith("-") | n.endswith("-") | n.contains("--"), "hyphens"), (F.char_length(n) > 10, "length")]).alias("message"))


@query("FN-S1", "SELECT p_partkey, list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS title FROM part")
def title_case(spark, sf):
    return table(spark, sf, "part").select("p_partkey", strings.title_case(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("title"))


@query("FN-S2 FN-S3", "SELECT p_partkey, '# ' || p_name || ' by ' || p_brand AS readme FROM part")
def template_fill(spark, sf):
    return table(spark, sf, "part").select("p_partkey", strings.fill("# {{NAME}} by {{BRAND}}", NAME=F.col("p_name"), BRAND=F.col("p_brand")).alias("readme"))


@query("FN-S7 FN-S8 FN-S11 FIL-15 FN-S9", "SELECT p_partkey, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) AS port, CAST(regexp_extract('v' || p_size || '.1', '^v?([0-9]+)', 1) AS INT) AS major, CAST(abs(p_size - 25) AS INT) AS distance FROM part WHERE CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) BETWEEN 1 AND 65535")
def parsed_numbers(spark, sf):
    port = strings.int_or(F.element_at(strings.full_lines(F.replace("p_brand", F.lit("#"), F.lit("\n"))), -1), 0)
    p = table(spark, sf, "part").select("p_partkey", port.cast("long").alias("port"), strings.major_version(F.concat(F.lit("v"), F.col("p_size").cast("string"), F.lit(".1"))).alias("major"), F.abs(F.col("p_size") - 25).alias("distance"))
    return p.where((F.col("port") > 0) & (F.col("port") < 65536))


@query("FIL-1 SET-1 SORT-8 FN-A1", "SELECT n_nationkey, array_to_string(list_sort(list_filter(['name', 'zeta' || n_nationkey, 'extra', 'license'], lambda k: NOT list_contains(['name', 'description', 'license'], k))), ', ') AS unexpected FROM nation")
def unexpected_keys(spark, sf):
    keys = F.array(F.lit("name"), F.concat(F.lit("zeta"), F.col("n_nationkey").cast("string")), F.lit("extra"), F.lit("license"))
    return table(spark, sf, "nation").select("n_nationkey", strings.key_difference(keys, ["name", "description", "license"]).alias("unexpected"))


@query("FIL-11 JOIN-4 SORT-1", "SELECT n_name FROM nation WHERE lower(n_name) IN ('nation_1', 'nation_7', 'nation_20')")
def allow_list(spark, sf):
    wanted = spark.createDataFrame([("Nation_1",), ("NATION_7",), ("nation_20",), ("nation_99",)], "name string")
    return registry.allowed_only(table(spark, sf, "nation"), "n_name", wanted).select("n_name").orderBy("n_name")


@query("FIL-12 JOIN-5 JOIN-21", "SELECT coalesce(c.k, s.k) AS k, CASE WHEN s.k IS NULL THEN 'only_listed' WHEN c.k IS NULL THEN 'only_there' ELSE 'both' END AS state FROM (SELECT DISTINCT c_nationkey AS k FROM customer) c FULL JOIN (SELECT DISTINCT s_nationkey AS k FROM supplier) s ON s.k = c.k")
def listed_and_there(spark, sf):
    return registry.consistency(table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")), "k")


@query("FIL-13 FIL-14", "SELECT conv_id, turn, CASE WHEN role = 'system' THEN array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), chr(10)) ELSE text END AS text FROM conversations WHERE NOT regexp_matches('/' || role || '/', '/(tool|cache)/')")
def line_filter(spark, sf):
    c = registry.without_folders(table(spark, sf, "conversations").withColumn("path", F.concat("role", F.lit("/"))), "path", ("tool", "cache"))
    return c.select("conv_id", "turn", registry.without_line(F.col("text"), "", F.col("role") == "system").alias("text"))


@query("CLS-6 CLS-7 CLS-8 CLS-10 CLS-11 FIL-21 FIL-27", """SELECT s_suppkey, CASE WHEN a THEN 'reflection' ELSE 'planning' END AS timing, CASE WHEN a::INT + b::INT + c::INT <> 1 THEN 'full' WHEN a THEN 'niche' WHEN b THEN 'primitive' ELSE 'frugal' END AS lens,
 CASE WHEN c THEN 'expose' WHEN a THEN 'keep' WHEN b THEN 'defer' ELSE 'cut' END AS disposition, a::INT + b::INT + c::INT AS tests, CASE WHEN 2 * (a::INT + b::INT + c::INT) > 3 THEN 'primitive' ELSE 'solution' END AS shape,
 CASE WHEN c THEN 'global rule' WHEN b THEN 'skill' WHEN a THEN 'prompt' ELSE 'answer' END AS container, CASE WHEN a AND b THEN 'hybrid' WHEN a THEN 'structure-first' ELSE 'compilation-first' END AS mode, a AND s_suppkey % 4 >= 2 AND b AS fan_out
 FROM (SELECT s_suppkey, s_acctbal > 5000 AS a, s_nationkey > 12 AS b, s_suppkey % 3 = 0 AS c FROM supplier)""")
def decision_axes(spark, sf):
    a, b, c = F.col("s_acctbal") > 5000, F.col("s_nationkey") > 12, F.col("s_suppkey") % 3 == 0
    return table(spark, sf, "supplier").select(
        "s_suppkey", classify.timing(a).alias("timing"), classify.lens(a, b, c).alias("lens"), classify.disposition(a, b, c).alias("disposition"), classify.opportunity(a, b, c).alias("tests"), classify.shape(a, b, c).alias("shape"),
        classify.container(a, b, c).alias("container"), classify.workspace_mode(a, b).alias("mode"), classify.fan_out(a, F.col("s_suppkey") % 4, b).alias("fan_out"),
    )


@query("FN-D1 FN-D2", "SELECT o_orderkey, strftime(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d'), '%Y%m%d') AS day, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02') AS INT) AS age FROM orders")
def order_age(spark, sf):
    o = table(spark, sf, "orders")
    day = strings.iso_date(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", F.date_format(day, "yyyyMMdd").alias("day"), F.datediff(F.lit("1998-08-02").cast("date"), day).alias("age"))


_HEADS = """SELECT CASE kind WHEN 0 THEN 'Skill is valid!' WHEN 1 THEN CASE WHEN n = upper(n) AND n = lower(n) THEN 'Skill is valid!' ELSE 'Name '''' should be hyphen-case (lowercase letters, digits, and hyphens only)' END
 WHEN 2 THEN 'Unexpected key(s) in SKILL.md frontmatter: extra. Allowed properties are: allowed-tools, description, license, metadata, name' WHEN 3 THEN 'No YAML frontmatter found' WHEN 4 THEN 'Name must be a string, got int' ELSE 'SKILL.md not found' END AS message, kind = 0 AS valid
 FROM (SELECT p_partkey % 6 AS kind, replace(p_name, ' ', '-') AS n FROM part)"""


@query("SRC-1 SRC-2 SRC-3 SRC-4 UDF-2 FIL-1 FIL-3 FIL-9", f"SELECT valid, message, count(*) AS n FROM ({_HEADS}) GROUP BY 1, 2")
def frontmatter_validate(spark, sf):
    """Documents made from the parts table, valid and faulty ones, run through the validator."""
    from ..operators.validate import validate

    p = table(spark, sf, "part")
    name = F.replace("p_name", F.lit(" "), F.lit("-"))
    kind = F.col("p_partkey") % 6
    head = F.when(kind == 0, F.concat(F.lit("---\nname: "), name, F.lit("\ndescription: fine\n---\n")))
    head = head.when(kind == 1, F.concat(F.lit("---\nname: "), F.upper(name), F.lit("\ndescription: fine\n---\n")))
    head = head.when(kind == 2, F.concat(F.lit("---\r\nname: "), name, F.lit("\r\nextra: 1\r\n---\r\n"))).when(kind == 3, "no header")
    head = head.when(kind == 4, F.concat(F.lit("---\nname: "), F.col("p_partkey").cast("string"), F.lit("\ndescription: x\n---\n")))
    folders = p.select(F.concat(name, F.lit("-"), F.col("p_partkey").cast("string")).alias("name"), head.cast("binary").alias("content"))
    return validate(folders).groupBy("valid", F.regexp_replace("message", "'[^']*'", "''").alias("message")).agg(F.count("*").alias("n"))


_X = "---\nname: {}\ndescription: {}\n---\n"
#: Header contents and the message of each; null stands for a missing file.
_HEADER_CASES = [
    ("missing file", None, "SKILL.md not found"),
    ("bad UTF-8", b"\xff", "SKILL.md must be valid UTF-8:"),
    ("BOM", "\ufeff---\nname: a\n---\n", "No YAML frontmatter found"),
    ("no fence", "hello", "No YAML frontmatter found"),
    ("unclosed", "---\nname: a\n", "Invalid frontmatter format"),
    ("empty header", "---\n---\n", "Invalid frontmatter format"),
    ("bad YAML", "---\nname: [\n---\n", "Invalid YAML in frontmatter:"),
    ("list header", "---\n- a\n---\n", "Frontmatter must be a YAML dictionary"),
    ("extra key and no name", "---\nfoo: 1\n---\n", "Unexpected key(s) in SKILL.md frontmatter: foo. Allowed properties are: allowed-tools, description, license, metadata, name"),
    ("no name", "---\ndescription: x\n---\n", "Missing 'name' in frontmatter"),
    ("no description", "---\nname: a\n---\n", "Missing 'description' in frontmatter"),
    ("int name", _X.format("123", "x"), "Name must be a string, got int"),
    ("upper-case", _X.format("Ab", "x"), "Name 'Ab' should be hyphen-case (lowercase letters, digits, and hyphens only)"),
    ("first hyphen", _X.format("-a", "x"), "Name '-a' cannot start or end with a hyphen or contain consecutive hyphens"),
    ("last hyphen", _X.format("a-", "x"), "Name 'a-' cannot start or end with a hyphen or contain consecutive hyphens"),
    ("two hyphens", _X.format("a--b", "x"), "Name 'a--b' cannot start or end with a hyphen or contain consecutive hyphens"),
    ("64 characters", _X.format("a" * 64, "x"), "Skill is valid!"),
    ("65 characters", _X.format("a" * 65, "x"), "Name is too long (65 characters). Maximum is 64 characters."),
    ("list description", _X.format("a", "[a]"), "Description must be a string, got list"),
    ("brackets", _X.format("a", "a -> b"), "Description cannot contain angle brackets (< or >)"),
    ("1024 characters", _X.format("a", "x" * 1024), "Skill is valid!"),
    ("1025 characters", _X.format("a", "x" * 1025), "Description is too long (1025 characters). Maximum is 1024 characters."),
    ("empty name and description", _X.format('""', '""'), "Skill is valid!"),
    ("CRLF", _X.format("a", "x").replace("\n", "\r\n"), "Skill is valid!"),
    ("four dashes", "---\nname: a\ndescription: x\n----\n", "Skill is valid!"),
]


@query("SRC-1 SRC-2 SRC-3 SRC-4 UDF-2 FIL-1 FIL-2 FIL-3 FIL-4 FIL-5 FIL-6 FIL-7 FIL-8 FIL-9 FIL-10", f"SELECT n_nationkey, name, message, message = 'Skill is valid!' AS valid FROM nation, (VALUES {sql_rows([(name, message) for name, _, message in _HEADER_CASES])}) AS c(name, message)")
def header_cases(spark, sf):
    """Every rule of the header contract, one case a row, in a folder of each nation; messages with a reason of the parser's end at the colon."""
    from ..operators.validate import validate

    own = F.concat_ws("/", F.col("n_nationkey").cast("string"), "c.name").alias("name")
    rows = table(spark, sf, "nation").select("n_nationkey", F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.lit(c if isinstance(c, bytes) or c is None else c.encode()).cast("binary").alias("content")) for n, c, _ in _HEADER_CASES))).alias("c"))
    found = validate(rows.select(own, "c.content"))
    message = F.regexp_replace("message", "(?s)^(SKILL.md must be valid UTF-8:|Invalid YAML in frontmatter:).*", "$1")
    return found.select(F.split_part("name", F.lit("/"), F.lit(1)).cast("int").alias("n_nationkey"), F.split_part("name", F.lit("/"), F.lit(2)).alias("name"), message.alias("message"), "valid")
