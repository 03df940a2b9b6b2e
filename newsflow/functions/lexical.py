"""Tokens, token ids, lexical weights and vector arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.text import bind

# What separates tokens, and how many hex digits of the hash make a token id.
TOKEN_BREAK = r"[^\p{L}\p{N}]+"
TOKEN_ID_DIGITS = 7


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda token: token != "")


def token_id(token: Column) -> Column:
    """A non-negative INT that depends on the token alone."""
    head = F.substr(F.sha2(token, 256), F.lit(1), F.lit(TOKEN_ID_DIGITS))
    return F.conv(head, 16, 10).cast("int")


def run_starts(ordered: Column, key=lambda item: item) -> Column:
    """Indexes at which a sorted array starts a new key."""
    return F.filter(
        F.sequence(F.lit(0), F.size(ordered) - 1),
        lambda i: (i == 0) | (key(F.get(ordered, i)) != key(F.get(ordered, i - 1))),
    )


def token_counts(text: Column) -> Column:
    """Distinct tokens with their counts, found by sorting within the row: no shuffle."""
    def count(ordered: Column) -> Column:
        def runs(starts: Column) -> Column:
            return F.transform(starts, lambda at, k: F.struct(
                F.get(ordered, at).alias("token"),
                (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - at).alias("n"),
            ))
        return F.when(F.size(ordered) > 0, bind(run_starts(ordered), runs)).otherwise(
            F.array().cast("array<struct<token:string,n:int>>"))
    return bind(F.sort_array(tokens(text)), count)


def lexical_weight(count: Column) -> Column:
    """Default weight of a token within its text: 1 + ln(count)."""
    return F.lit(1.0) + F.log(count.cast("double"))


def max_by_token(entries: Column) -> Column:
    """Array of (id, weight) to the same sorted by id, keeping the largest weight of equal ids."""
    def collapse(ordered: Column) -> Column:
        last = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == F.size(ordered) - 1)
            | (F.get(ordered, i)["id"] != F.get(ordered, i + 1)["id"]),
        )
        repeated = F.size(F.array_distinct(ordered["id"])) < F.size(ordered)
        return F.when(repeated, F.transform(last, lambda i: F.get(ordered, i))).otherwise(ordered)
    return bind(F.sort_array(entries), collapse)


def sparse_entries(text: Column) -> Column:
    """A text as array of (token id, weight), ascending by id."""
    return max_by_token(F.transform(token_counts(text), lambda entry: F.struct(
        token_id(entry["token"]).alias("id"),
        lexical_weight(entry["n"]).alias("weight"),
    )))


def dot(a: Column, b: Column) -> Column:
    """Dot product of two equally long arrays, in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 when one of them is zero."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length).otherwise(F.lit(0.0))
