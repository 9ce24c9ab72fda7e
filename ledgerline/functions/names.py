"""Company names as join keys, and column names as identifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import keep_word_chars, squeeze, strip

# Suffixes removed from company names, in this order.
NAME_SUFFIXES = [
    "inc", "ltd", "corp", "corporation", "company", "co", "limited",
    "ltee", "ltda", "pty", "plc",
]

# Whole words removed from match keys.
KEY_WORDS = [
    "inc", "ltd", "corp", "corporation", "company", "co", "limited", "ltee", "ltda",
]


def normalize_company_name(c: Column) -> Column:
    """Lower-case name without suffixes and punctuation; null becomes ''.

    Suffixes go by plain substring, so "acme consulting" loses " co" as well;
    ``match_key`` works on whole words.
    """
    out = strip(F.lower(c))
    for suffix in NAME_SUFFIXES:
        for tail in (suffix, suffix + "."):
            out = F.replace(out, F.lit(" " + tail), F.lit(""))
    return F.coalesce(strip(squeeze(keep_word_chars(out))), F.lit(""))


def match_key(c: Column) -> Column:
    """Key for matching a name to a registry; null stays null."""
    plain = F.regexp_replace(F.lower(c), r"(?U)[^\w\s]", "")
    words = r"(?U)\b(" + "|".join(KEY_WORDS) + r")\b"
    return strip(F.regexp_replace(strip(squeeze(plain)), words, ""))


def to_snake(name: str) -> str:
    """Column name in snake case: ``RegAddress.PostTown`` -> ``reg_address_post_town``."""
    name = re.sub(r"[. ]", "_", name)
    name = re.sub(r"(?<=.)(?=[A-Z][a-z])|(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return re.sub("_+", "_", name.lower()).strip("_")
