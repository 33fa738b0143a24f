"""Text clean-up, value maps and the role-keyed rate text."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import SPACE, to_number


# an entry of a plain map is a quoted role, a colon, and a decimal number, None or a quoted text
_VALUE = r"""\s*[+-]?(?:0|[1-9]\d*)(?:\.\d*)?\s*|\s*None\s*|\s*'[^'\\]*'\s*|\s*"[^"\\]*"\s*"""
RATE_ENTRY = rf"""(['"])([^'"\\]*)\1\s*:({_VALUE})"""
RATE_VALUE = rf"""^\s*:({_VALUE})"""
_ENTRY = rf"""\s*(?:'[^'\\]*'|"[^"\\]*")\s*:(?:{_VALUE})"""
RATE_MAP = rf"^{SPACE}*\{{{_ENTRY}(?:,{_ENTRY})*,?\s*\}}{SPACE}*\z"
QUOTES = r"""^\s*['"]|['"]\s*$"""

# the tokens of other maps: quoted texts with escapes, marks, words, and any other character
_TEXT = r"""'(?:[^'\\\n]|\\.)*+'|"(?:[^"\\\n]|\\.)*+\""""
TOKEN = rf"""(?s){_TEXT}|[\[\](){{}}:,]|[^\s\[\](){{}}:,'"]+|\S"""
NUMBER_WORD = (
    r"(?i)^[+-]?(?:0x_?[0-9a-f]+(?:_[0-9a-f]+)*|0o_?[0-7]+(?:_[0-7]+)*|0b_?[01]+(?:_[01]+)*|0+(?:_0+)*|[1-9]\d*(?:_\d+)*"
    r"|(?:\d+(?:_\d+)*\.(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:e[+-]?\d+(?:_\d+)*)?|\d+(?:_\d+)*e[+-]?\d+(?:_\d+)*)\z"
)
NAMES = {"True": 1.0, "False": 0.0}
BASES = {"x": 16, "o": 8, "b": 2}


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` only removes blanks)."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+\z", "")


def canonical(c: Column, spellings: Mapping[str, str]) -> Column:
    """Look up the canonical value of a spelling; unknown spellings become NULL. Whitespace around it is
    only looked for in spellings that are not known as they are."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(spellings.items())])
    return F.coalesce(F.try_element_at(table, F.upper(c)), F.try_element_at(table, F.upper(strip(c))))


def rate_for_role(rate_text: Column, role: Column) -> Column:
    """A rate given either as a plain number or as ``{'role': rate, ...}`` text keyed by role.

    Other roles may have no usable rate (``None``), a comma may follow the last entry, and of entries
    with the same role the last one counts. Maps of decimal numbers, None and texts without escapes are
    read by patterns; any other map is read token by token, see :func:`literal_rate`.
    """
    mention = F.concat(F.lit("'"), role, F.lit("'"))
    after = F.call_function("substring_index", rate_text, mention, F.lit(-1))
    listed = F.when(F.contains(rate_text, role), listed_rate(rate_text, role))
    # what follows the role's last mention is its rate, unless the role stands there as a rate itself
    plain = ~F.contains(rate_text, F.lit('"'))
    own = once(F.regexp_extract(after, RATE_VALUE, 1), lambda v: F.when((v != "") & plain, v).otherwise(listed))
    rate = once(own, lambda v: number_with_marks(F.regexp_replace(v, QUOTES, "")))
    is_map = F.contains(rate_text, F.lit("{"))
    read = F.when(F.regexp_like(rate_text, F.lit(RATE_MAP)), rate).when(is_map, literal_rate(rate_text, role))
    return F.coalesce(number_with_marks(rate_text), read)


def number_with_marks(c: Column) -> Column:
    """As :func:`to_number`, with single underscores between digits."""
    return to_number(F.when(F.contains(c, F.lit("_")), F.regexp_replace(c, r"(?<=\d)_(?=\d)", "")).otherwise(c))


def literal_rate(rate_text: Column, role: Column) -> Column:
    """The role's rate in a map written as a literal: a fold over its tokens.

    The fold keeps the open brackets, what may come next, the entry's key and value, and the rate found so
    far. Next is ``item`` (an item, or the closing bracket), ``key`` (a colon must follow a map's key),
    ``value`` (a colon came: an item must follow), ``after`` (a comma or the closing bracket), ``end`` or
    ``bad``. Lists, tuples, sets and maps may stand as other roles' rates, parentheses around a rate.
    A text is not a map, and has no rate, if it breaks the grammar anywhere.
    """
    text = T.StringType()
    start = F.struct(
        F.lit("").alias("open"), F.lit("item").alias("next"), F.lit(None).cast(text).alias("key"), F.lit(None).cast(text).alias("value"), F.lit(None).cast(text).alias("rate")
    )

    def step(at: Column, token: Column) -> Column:
        brackets, due = at["open"], at["next"]
        depth, top = F.length(brackets), F.right(brackets, F.lit(1))
        opens, closes = F.instr(F.lit("{[("), token) > 0, F.instr(F.lit("}])"), token) > 0
        quoted = F.substring(token, 1, 1).isin("'", '"') & (F.length(token) > 1)
        atom = quoted | token.isin("None", *NAMES) | F.regexp_like(token, F.lit(NUMBER_WORD))
        may_begin = due.isin("item", "value")
        matches = F.concat(top, token).isin("{}", "[]", "()", "<)")
        in_map = top == "{"
        as_key = in_map & (due == "item")
        # a key without a value makes a set, which only the outermost bracket may not be
        ended = (due == "after") | ((due == "key") & (depth > 1))
        last = (depth == 1) & (due == "after")  # an entry of the map itself is complete
        following = (
            F.when(depth == 0, F.when((token == "{") & (due == "item"), "item").otherwise("bad"))
            .when(opens, F.when(may_begin & ~(as_key & (token != "(")), "item").otherwise("bad"))
            .when(
                closes,
                F.when(~matches | ~(ended | (due == "item")), "bad").when(depth == 1, "end").when(top == "<", "key").otherwise("after"),
            )
            .when(token == ",", F.when(ended, "item").otherwise("bad"))
            .when(token == ":", F.when(in_map & (due == "key"), "value").otherwise("bad"))
            .when(atom & may_begin, F.when(in_map & (due == "item"), "key").otherwise("after"))
            .otherwise("bad")
        )
        around = F.substr(brackets, F.lit(1), depth - 1)
        wrapped = F.regexp_like(brackets, F.lit(r"^\{\(*$"))
        key = F.when((depth == 1) & (due == "item"), F.when(atom, token)).otherwise(at["key"])
        value = (
            F.when((depth == 1) & (due == "item"), F.lit(None))
            .when(wrapped & atom & ((due == "value") | (depth > 1)) & at["value"].isNull(), token)
            .when((depth > 1) & ((token == ",") | ~wrapped), "()")  # a tuple, or what holds one, is no rate
            .otherwise(at["value"])
        )
        found = F.when(last & (closes | (token == ",")) & (literal_text(at["key"]) == role), at["value"]).otherwise(at["rate"])
        # a bracket that stands as a key is kept as "<"
        open_now = F.when(opens, F.concat(brackets, F.when(as_key & (depth > 0), "<").otherwise(token))).when(closes, around).otherwise(brackets)
        after_end = F.when(due.isin("end", "bad"), "bad").otherwise(following)
        return F.struct(open_now.alias("open"), after_end.alias("next"), key.alias("key"), value.alias("value"), found.alias("rate"))

    tokens = F.regexp_extract_all(rate_text, F.lit(TOKEN), F.lit(0))
    read = F.aggregate(tokens, start, step, lambda at: F.when(at["next"] == "end", at["rate"]))
    return once(read, literal_number)


def literal_text(token: Column) -> Column:
    """The text a quoted token stands for; other tokens give NULL. Quotes and backslashes may be escaped."""
    inner = F.substr(token, F.lit(2), F.length(token) - 2)
    return F.when(F.substring(token, 1, 1).isin("'", '"'), F.regexp_replace(inner, r"""\\(['"\\])""", "$1"))


def literal_number(token: Column) -> Column:
    """The number that a token stands for: a number in any base, a truth value, or a text that is one."""
    digits = F.replace(F.lower(token), F.lit("_"), F.lit(""))
    body = F.regexp_replace(digits, r"^[+-]", "")
    sign = F.when(F.startswith(digits, F.lit("-")), -1.0).otherwise(1.0)
    based = F.lit(None).cast("double")
    for mark, base in BASES.items():
        value = F.conv(F.substr(body, F.lit(3)), base, 10).try_cast("double")
        based = F.when(F.startswith(body, F.lit(f"0{mark}")), sign * value).otherwise(based)
    named = F.lit(None).cast("double")
    for name, value in NAMES.items():
        named = F.when(token == name, value).otherwise(named)
    return F.coalesce(named, based, number_with_marks(F.coalesce(literal_text(token), token)))


def once(c: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(c), then), F.lit(0))


def listed_rate(rate_text: Column, role: Column) -> Column:
    """The rate of the last entry with that role, entry by entry."""
    roles = F.reverse(F.regexp_extract_all(rate_text, F.lit(RATE_ENTRY), F.lit(2)))
    rates = F.reverse(F.regexp_extract_all(rate_text, F.lit(RATE_ENTRY), F.lit(3)))
    return F.try_element_at(rates, F.nullif(F.array_position(roles, role), F.lit(0)).cast("int"))


def raw_json(*columns) -> Column:
    """The original values as JSON text, whole, NULL fields kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
