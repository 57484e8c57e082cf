"""Prose rewriting and checks as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Overused phrases and their plain forms, in the order in which they apply; empty deletes.
WORD_SWAPS = (
    ("in order to", "to"), ("prior to", "before"), ("due to the fact that", "because"), ("in the event that", "if"),
    ("it is worth noting that", ""), ("it's important to", ""), ("it is important to", ""), ("leverage", "use"),
    ("utilize", "use"), ("harness", "use"), ("seamlessly", ""), ("effortlessly", ""), ("simply", ""), ("robust", ""),
    ("comprehensive", ""), ("crucial", "important"), ("pivotal", "important"), ("paramount", "important"),
    ("facilitate", "help"), ("delve into", "examine"), ("dive into", "examine"), ("showcase", "show"),
    ("underscore", "show"), ("furthermore", "also"), ("moreover", "also"), ("in conclusion", ""), ("in summary", ""),
    ("holistic", "full"), ("plethora", "many"), ("myriad", "many"), ("cutting-edge", "new"), ("state-of-the-art", "new"),
    ("groundbreaking", "new"), ("streamline", "simplify"), ("when it comes to", "for"),
)
# What a style check calls slop, by prefix.
SLOP_PREFIXES = ("leverage", "utilize", "seamless", "robust", "crucial", "comprehensive", "in order to", "it is worth noting")
# Fixed value: a credential in an assignment.
SECRET = r"(?i)(?:password|secret|api_key|apikey|token|private_key)\s*[:=]\s*['\"]?[A-Za-z0-9_\-+/=]{8,}['\"]?"

#: The same replacements in the order of sanitize(), as (pattern, replacement).
REWRITES = (
    (r"\s*[—–]\s*([^—–]*?)\s*[—–]\s*", ", $1, "),
    (r"\s*[—–]\s*", ". "),
    (r"\s*;\s*", ". "),
    (r"(?i)\b(should|would|may|might|could)\b(?!\s*(not|be\s+used))", "can"),
    (r"[ \t]{2,}", " "),
    (r" ([,.:!?])", "$1"),
    (r"\.\s*\.", "."),
    (r"(^|\n)\s*\.\s*", "$1"),
    (r",\s*\.", "."),
)


def swap_words(text: Column) -> Column:
    for phrase, plain in WORD_SWAPS:
        text = F.regexp_replace(text, rf"(?i)\b{phrase}\b", plain)
    return text


def sanitize(text: Column) -> Column:
    """Plain prose: word swaps, no dashes and semicolons, no hedges, tidy blanks."""
    text = swap_words(text)
    for pattern, replacement in REWRITES:
        text = F.regexp_replace(text, pattern, replacement)
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def style_violations(text: Column) -> Column:
    """Array of the names of the rules that the text breaks."""
    found = [F.when(text.rlike("[—–]"), "em-dash"), F.when(F.contains(text, F.lit(";")), "semicolon"), F.when(text.rlike(r"(?i)\b(should|would|may|might)\b"), "hedge-modal")]
    found += [F.when(text.rlike(rf"(?i)\b{p}"), f"slop:{p}") for p in SLOP_PREFIXES]
    return F.array_compact(F.array(*found))


def redact_secrets(text: Column) -> Column:
    return F.regexp_replace(text, SECRET, "[REDACTED]")


def clean_text(content: Column, max_null_share: float = 0.01) -> Column:
    """Redacted text of a binary file; null for binary, undecodable, empty or null-ridden content."""
    head = F.hex(F.substring(content, 1, 4))
    binary = head.startswith("00") | head.startswith("FFFE") | head.startswith("FEFF") | (head == "7F454C46")
    text = F.try_validate_utf8(content.cast("string"))
    nulls = F.length(text) - F.length(F.replace(text, F.lit("\0"), F.lit("")))
    good = ~binary & text.isNotNull() & (F.trim(F.regexp_replace(text, r"\s+", " ")) != "") & (nulls <= max_null_share * F.length(text))
    return F.when(good, redact_secrets(text))


def clean_markdown(text: Column) -> Column:
    """Sanitised prose around untouched fenced blocks; bold marks go, parts are separated by blank lines."""
    fence = r"(?s)```.*?```"
    prose = F.transform(F.split(text, fence, -1), lambda p: sanitize(F.regexp_replace(p, r"\*\*([^*]+)\*\*", "$1")))
    blocks = F.concat(F.regexp_extract_all(text, F.lit(fence), 0), F.array(F.lit("")))
    woven = F.flatten(F.zip_with(prose, blocks, lambda p, b: F.array(p, b)))
    return F.array_join(F.filter(woven, lambda x: x != ""), "\n\n")
