"""Column expressions shared by the operators that use built-in functions only."""

from pyspark.sql import functions as F

# What separates words: ASCII white space.
BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def bound(value, body):
    """`body` of a value that is worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text):
    return F.filter(F.split(text, f"{BLANK}+", -1), lambda word: word != "")
