"""Which columns hold sensitive data, by their names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values, in match order: name pattern (% at the start or both ends), category, mask strategy.
RULES = (
    ("%email%", "Email", "email"),
    ("%e_mail%", "Email", "email"),
    ("%first_name%", "PII - Name", "name"),
    ("%last_name%", "PII - Name", "name"),
    ("%full_name%", "PII - Name", "name"),
    ("%firstname%", "PII - Name", "name"),
    ("%lastname%", "PII - Name", "name"),
    ("%fullname%", "PII - Name", "name"),
    ("%_name", "PII - Name", "name"),
    ("%phone%", "Phone", "phone"),
    ("%mobile%", "Phone", "phone"),
    ("%telephone%", "Phone", "phone"),
    ("%fax%", "Phone", "phone"),
    ("%ssn%", "National ID", "null"),
    ("%social_security%", "National ID", "null"),
    ("%national_id%", "National ID", "null"),
    ("%tax_id%", "National ID", "null"),
    ("%taxpayer%", "National ID", "null"),
    ("%salary%", "Financial", "random_int"),
    ("%income%", "Financial", "random_int"),
    ("%wage%", "Financial", "random_int"),
    ("%compensation%", "Financial", "random_int"),
    ("%password%", "Credential", "hash"),
    ("%passwd%", "Credential", "hash"),
    ("%secret%", "Credential", "hash"),
    ("%token%", "Credential", "hash"),
    ("%api_key%", "Credential", "hash"),
    ("%apikey%", "Credential", "hash"),
    ("%address%", "Address", "constant"),
    ("%street%", "Address", "constant"),
    ("%zip%", "Address", "partial"),
    ("%zipcode%", "Address", "partial"),
    ("%postal%", "Address", "partial"),
    ("%birth%", "Date of Birth", "null"),
    ("%dob%", "Date of Birth", "null"),
    ("%date_of_birth%", "Date of Birth", "null"),
    ("%card_number%", "Credit Card", "null"),
    ("%credit_card%", "Credit Card", "null"),
    ("%ccn%", "Credit Card", "null"),
    ("%cvv%", "Credit Card", "null"),
    ("%ip_address%", "IP Address", "hash"),
    ("%ipaddress%", "IP Address", "hash"),
)


def ordered() -> list[tuple[int, str, str, str]]:
    """(ord, pattern, category, strategy) of every rule, in match order."""
    return [(i, *rule) for i, rule in enumerate(RULES, 1)]


def rules(spark: SparkSession) -> DataFrame:
    """The rules as a relation."""
    return spark.createDataFrame(ordered(), "ord int, pattern string, category string, strategy string")


def _pattern(cores: list[tuple[str, bool]]) -> str:
    """Looks ahead at every place of a name for a core. Cores that can match at one place begin alike, so they are grouped
    by their first character and tried in match order within a group."""
    groups: dict[str, list[str]] = {}
    for core, inside in cores:
        groups.setdefault(core[0], []).append(re.escape(core[1:]) + ("" if inside else r"\z"))
    return "(?=(" + "|".join(f"{re.escape(first)}(?:{'|'.join(rest)})" for first, rest in groups.items()) + "))"


def classify(name: Column) -> Column:
    """struct(ord, category, strategy) of the first rule that the name matches, null without one.

    One pass of a pattern finds the cores in the name, overlapping ones too; the smallest order among them is looked up
    in constants. _ is a plain character, case is ignored.
    """
    cores = [(pattern.strip("%"), pattern.endswith("%")) for _, pattern, *_ in ordered()]
    found = F.regexp_extract_all(F.lower(name), F.lit(_pattern(cores)), F.lit(1))
    orders = F.expr("map(" + ", ".join(f"'{core}', {i}" for i, (core, _) in enumerate(cores, 1)) + ")")
    rules = F.expr("array(" + ", ".join(f"named_struct('ord', {i}, 'category', '{category}', 'strategy', '{strategy}')" for i, _, category, strategy in ordered()) + ")")
    return F.get(rules, F.array_min(F.transform(found, lambda core: F.element_at(orders, core))) - 1)
