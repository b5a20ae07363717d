"""Sums of amounts of any finite size, exact and independent of row order, out of built-in functions.

A double is summed as the decimal number it is written as. One decimal type cannot hold all amounts, so each goes
to one of four sums by its size and number of places: ordinary ones (below 10^11, up to 16 places) to a decimal of
16 places, large ones (below 10^22, which have six places at most) to one of 6, fine ones (below 1, up to 28 places) to
one of 28. Only these three together decide a total: whole parts and fractions are added apart, exactly, and the
nearest double is taken once. What is larger or finer still is kept as a double sum and added to that.

All four are plain sums, so partial results combine in any order. An amount is in one of them; the other three are
NULL, and in most data three of the sums stay NULL for good.
"""


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDINARY, LARGE, FINE = T.DecimalType(28, 16), T.DecimalType(28, 6), T.DecimalType(28, 28)

#: Suffix of each part's column -> type of an amount, type of a sum.
PARTS = {
    "": (ORDINARY, T.DecimalType(38, 16)),
    "_large": (LARGE, T.DecimalType(38, 6)),
    "_fine": (FINE, T.DecimalType(38, 28)),
    "_rest": (T.DoubleType(), T.DoubleType()),
}

#: From 1 up to here a double has no more than 16 places; a division of 10^8 shows most fractions to be short.
_ORDINARY_LIMIT, _LARGE_LIMIT, _SHORT = "1e11", "1e22", "1e8"
#: How a fraction is written out.
_PLACES = "0." + "0" * 28


def sum_fields(name: str) -> list[T.StructField]:
    """The columns that hold a sum."""
    return [T.StructField(name + suffix, kind) for suffix, (_, kind) in PARTS.items()]


# Expressions are written as SQL text: each is large, and as text it reaches the analyzer in one piece.


def _survives(amount: str, kind: T.DecimalType) -> str:
    return f"CAST(TRY_CAST({amount} AS {kind.simpleString()}) AS DOUBLE) = {amount}"


def _kind(amount: str) -> str:
    """Which part an amount belongs to, as the part's place in PARTS. Casts to decimals are left to small fractions."""
    return f"""
    CASE WHEN abs({amount}) >= 1
         THEN CASE WHEN abs({amount}) <= {_ORDINARY_LIMIT}D THEN 0 WHEN abs({amount}) < {_LARGE_LIMIT}D THEN 1 ELSE 3 END
         WHEN rint(abs({amount}) * {_SHORT}D) / {_SHORT}D = abs({amount}) THEN 0
         WHEN {_survives(amount, ORDINARY)} THEN 0
         WHEN {_survives(amount, FINE)} THEN 2
         ELSE 3 END"""


def _parts(amount: str, kind: str) -> dict[str, str]:
    return {
        suffix: f"CASE WHEN {kind} = {place} THEN TRY_CAST({amount} AS {one.simpleString()}) END"
        for place, (suffix, (one, _)) in enumerate(PARTS.items())
    }


def with_parts(frame: DataFrame, *names: str) -> DataFrame:
    """The frame with columns ``_name``, ``_name_large``, ``_name_fine`` and ``_name_rest`` for each amount."""
    kinds = frame.withColumns({f"_{n}_kind": F.expr(_kind(n)) for n in names})
    return kinds.withColumns(
        {f"_{n}{suffix}": F.expr(part) for n in names for suffix, part in _parts(n, f"_{n}_kind").items()}
    )


def sums(name: str, alias: str, only: str | None = None) -> list[Column]:
    """Aggregates over an amount's parts, of all rows or of those that meet a condition."""
    found = []
    for suffix in PARTS:
        part = f"_{name}{suffix}"
        if only is not None:
            part = f"CASE WHEN {only} THEN {part} END"
        folded = f"sum({part})"
        if only is not None and not suffix:
            # A sum of no ordinary amounts is 0, so that it differs from one that overflowed. Counts tell: they cost
            # less than adding a 0 for each amount that is left out.
            none = f"count({part}) = 0 AND count(CASE WHEN {only} THEN NULL ELSE 1 END) > 0"
            folded = f"CASE WHEN {none} THEN CAST(0 AS {PARTS[''][1].simpleString()}) ELSE {folded} END"
        found.append(F.expr(folded).alias(alias + suffix))
    return found


def exact_sum(name: str) -> Column:
    """The sum of an amount as one aggregate expression; NULL without any amount."""
    return F.expr(_folded([("", {suffix: f"sum({part})" for suffix, part in _parts(name, _kind(name)).items()})]))


def total(name: str) -> Column:
    """The double nearest to a sum that is held in columns."""
    return F.expr(_folded([("", _columns(name))]))


def difference(name: str, other: str) -> Column:
    """The double nearest to the difference of two sums; a sum of nothing is 0."""
    return F.expr(_folded([("", _columns(name)), ("-", _columns(other))]))


def _columns(name: str) -> dict[str, str]:
    return {suffix: name + suffix for suffix in PARTS}


def _folded(terms: list[tuple[str, dict[str, str]]]) -> str:
    unusual = [parts[suffix] for _, parts in terms for suffix in ("_large", "_fine", "_rest")]
    plain = " AND ".join(f"{part} IS NULL" for part in unusual)
    return f"CASE WHEN {plain} THEN {_ordinary(terms)} ELSE {_wide(terms)} END"


def _ordinary(terms) -> str:
    if len(terms) == 1:
        return f"CAST({terms[0][1]['']} AS DOUBLE)"
    # With one digit less in front the difference keeps all places.
    first, second = (f"CAST(coalesce({parts['']}, 0BD) AS DECIMAL(37,16))" for _, parts in terms)
    return f"CAST({first} - {second} AS DOUBLE)"


def _wide(terms) -> str:
    """Whole parts and fractions are added apart, then written out: text to double rounds once."""
    whole, fraction, rest = "CAST(0 AS DECIMAL(35,0))", "CAST(0 AS DECIMAL(33,28))", "0D"
    for sign, parts in terms:
        sign = sign or "+"
        for suffix in ("", "_large", "_fine"):
            part = f"coalesce({parts[suffix]}, CAST(0 AS {PARTS[suffix][1].simpleString()}))"
            cut = f"CAST(CASE WHEN {part} < 0 THEN ceil({part}) ELSE floor({part}) END AS DECIMAL(35,0))"
            # A remainder has the dividend's sign and all its places.
            left = f"CAST({part} % CAST(1 AS DECIMAL(1,0)) AS DECIMAL(33,28))"
            whole = f"CAST({whole} {sign} {cut} AS DECIMAL(35,0))"
            fraction = f"CAST({fraction} {sign} {left} AS DECIMAL(33,28))"
        rest = f"{rest} {sign} coalesce({parts['_rest']}, 0D)"
    # A lambda's argument is computed once, however often its body names it.
    settled = f"""
    element_at(transform(array(struct({whole} AS w, {fraction} AS f)), p -> struct(
        CAST(p.w + CAST(floor(p.f) AS DECIMAL(5,0)) AS DECIMAL(36,0)) AS w,
        CAST(p.f - CAST(floor(p.f) AS DECIMAL(5,0)) AS DECIMAL(33,28)) AS f)), 1)"""
    # -3 and 0.25 are written as -2 and 0.75.
    text = f"""
    element_at(transform(array({settled}), p -> CASE WHEN p.w < 0 AND p.f > 0
        THEN concat('-', CAST(CAST(-p.w - 1BD AS DECIMAL(36,0)) AS STRING),
                    substring(to_char(CAST(1BD - p.f AS DECIMAL(33,28)), '{_PLACES}'), -29, 29))
        ELSE concat(CAST(p.w AS STRING), substring(to_char(p.f, '{_PLACES}'), -29, 29)) END), 1)"""
    return f"(CAST({text} AS DOUBLE) + {rest})"
