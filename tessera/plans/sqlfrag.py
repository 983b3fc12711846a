"""SQL fragments for the oracle side."""


def rate_sql(n: str, d: str, scale: int = 100, digits: int = 2) -> str:
    """round(n / d * scale, digits) half-up on the exact ratio of two
    non-negative integers, via integer arithmetic (no float tie errors)."""
    p = 10 ** digits
    return (f"CASE WHEN ({d}) > 0 THEN CAST((CAST({n} AS HUGEINT) * {scale * p * 2} + ({d})) // (2 * ({d})) AS DOUBLE)"
            f" / {p} END")


def year_label_sql(name: str, day: str) -> str:
    """The number that the digits of a year's name make up, else the date's year."""
    digits = f"array_to_string(regexp_extract_all({name}, '[0-9]'), '')"
    return f"coalesce(TRY_CAST({digits} AS INTEGER), CAST(date_part('year', {day}) AS INTEGER))"


def term_label_sql(name: str) -> str:
    """A period's label: numbers by a lookup, names that are labels, else the first term."""
    lookup = "MAP {" + ", ".join(f"'{n}': 'TERM {n}'" for n in (1, 2, 3)) + "}"
    return f"coalesce({lookup}[{name}], CASE WHEN starts_with(upper({name}), 'TERM') THEN upper({name}) END, 'TERM 1')"


def first_live_sql(table: str, key: str, levels: list[str], live: str) -> str:
    """(key, unit): of a row's candidate columns the first in ``levels`` that
    the query ``live`` lists; rows without one are left out."""
    return (f"(SELECT c.{key}, arg_min(c.unit, c.place) AS unit FROM (SELECT {key}, unnest([{', '.join(levels)}]) AS unit, "
            f"unnest(range({len(levels)})) AS place FROM {table}) c WHERE c.unit IN ({live}) GROUP BY c.{key})")


def given_name_sql(first: str, other: str) -> str:
    return f"trim(concat_ws(' ', {first}, {other}))"
