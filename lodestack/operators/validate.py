"""Validation of document folders: ordered rules over the parsed header."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import key_difference, strip_unicode
from ..sources.documents import header_text, newlines, parse_headers, valid_text
from .rules import first_failure

# The closed key list, the limits and the messages of the header contract.
ALLOWED = ["allowed-tools", "description", "license", "metadata", "name"]
NAME_LIMIT, DESCRIPTION_LIMIT = 64, 1024
OK = "Skill is valid!"


def validate(folders: DataFrame, strict_name: bool = False) -> DataFrame:
    """name (of the folder), valid and message for rows (name, content: binary or null) (FIL-1 to FIL-10).

    The rules run in order and the first that fails gives the message.  Empty
    names and descriptions pass.  With ``strict_name`` the name must also equal
    the folder's.
    """
    text = folders.select("name", "content", newlines(valid_text("content")).alias("_text"))
    parsed = parse_headers(text.withColumn("_header", header_text(F.col("_text"))), "_header", "_p")
    p = lambda f: F.col(f"_p.{f}")
    name, description = strip_unicode(p("name")), strip_unicode(p("description"))
    unexpected = key_difference(p("keys"), ALLOWED)
    named, described = name != "", description != ""
    rules = [
        (F.col("content").isNull(), "SKILL.md not found"),
        (F.col("_text").isNull(), "SKILL.md must be valid UTF-8: invalid byte sequence"),
        (~F.col("_text").startswith("---"), "No YAML frontmatter found"),
        (F.col("_header").isNull(), "Invalid frontmatter format"),
        (p("error").isNotNull(), F.concat(F.lit("Invalid YAML in frontmatter: "), p("error"))),
        (~p("is_map"), "Frontmatter must be a YAML dictionary"),
        (unexpected != "", F.concat(F.lit("Unexpected key(s) in SKILL.md frontmatter: "), unexpected, F.lit(". Allowed properties are: " + ", ".join(ALLOWED)))),
        (~F.array_contains(p("keys"), "name"), "Missing 'name' in frontmatter"),
        (~F.array_contains(p("keys"), "description"), "Missing 'description' in frontmatter"),
        (p("name_type") != "str", F.concat(F.lit("Name must be a string, got "), p("name_type"))),
        (named & ~name.rlike(r"\A[a-z0-9-]+\z"), F.concat(F.lit("Name '"), name, F.lit("' should be hyphen-case (lowercase letters, digits, and hyphens only)"))),
        (named & (name.startswith("-") | name.endswith("-") | name.contains("--")), F.concat(F.lit("Name '"), name, F.lit("' cannot start or end with a hyphen or contain consecutive hyphens"))),
        (F.char_length(name) > NAME_LIMIT, F.concat(F.lit("Name is too long ("), F.char_length(name).cast("string"), F.lit(f" characters). Maximum is {NAME_LIMIT} characters."))),
        (p("description_type") != "str", F.concat(F.lit("Description must be a string, got "), p("description_type"))),
        (described & description.rlike("[<>]"), "Description cannot contain angle brackets (< or >)"),
        (F.char_length(description) > DESCRIPTION_LIMIT, F.concat(F.lit("Description is too long ("), F.char_length(description).cast("string"), F.lit(f" characters). Maximum is {DESCRIPTION_LIMIT} characters."))),
    ]
    if strict_name:
        rules.append((named & (name != F.col("name")), "Name must equal the folder's name"))
    return parsed.select("name", first_failure(rules, OK).alias("message")).withColumn("valid", F.col("message") == OK)
