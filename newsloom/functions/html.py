"""HTML fragment to plain text, as one chain of built-in expressions.

Character references follow the HTML standard (WHATWG, "Character reference
state") for text outside attributes, which is what Python's ``html.unescape``
documents too: a name with its semicolon is read as a whole; otherwise the
longest of the legacy names that need none is read and the rest stays; numbers
128-159 are Windows-1252, zero, surrogates and numbers beyond Unicode are
U+FFFD. The content of a CDATA section counts as text.
"""

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import strip

# Elements whose text is not article text.
HIDDEN = ["script", "style", "template", "rt", "rp"]

# The references that make up nearly all of real markup.
COMMON = {"quot": '"', "lt": "<", "gt": ">", "nbsp": "\u00a0", "#39": "'"}

# Unicode noncharacters, reserved for internal use: they cannot occur in text.
_BREAK = "\ufdd0"
_AMP = "\ufdd1"
_QUOTED = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>"""
_MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|<({'|'.join(HIDDEN)})(?![\w:-])[^>]*>.*?(?:</\1\s*>|\z)"
    r"|<[!?][^>]*>"
    rf"|</?[a-z]{_QUOTED}"
    r"|</?[a-z][^>]*>"
)
_CDATA = r"(?is)<!\[CDATA\[(.*?)\]\]>"


@lru_cache(maxsize=1)
def _names_json():
    """{first letter: {name: text}} of the standard entity names."""
    table = {}
    for name, text in html5.items():
        if name.endswith(";"):
            table.setdefault(name[0], {})[name[:-1]] = text
    return json.dumps(table)


# Names that are also read without a semicolon, by length, longest first.
LEGACY_LENGTHS = sorted({len(name) for name in html5 if not name.endswith(";")}, reverse=True)


@lru_cache(maxsize=1)
def _legacy_json():
    return json.dumps({name: text for name, text in html5.items() if not name.endswith(";")})


@lru_cache(maxsize=1)
def _windows_json():
    """Code points of the numbers 128-159 where Windows-1252 has a character."""
    return json.dumps({
        str(n): ord(bytes([n]).decode("cp1252")) for n in range(128, 160) if bytes([n]).decode("cp1252", "ignore")
    })


def _code_point(number) -> Column:
    """Text of a code point; U+FFFD for what is not a character."""
    windows = F.from_json(F.lit(_windows_json()), "map<string,bigint>")
    number = F.coalesce(F.try_element_at(windows, number.cast("string")), number)
    bad = (number < 1) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    safe = F.when(number.isNull() | bad, F.lit(0xFFFD).cast("bigint")).otherwise(number)
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def _number(digits, base) -> Column:
    """The value of some digits of any number; null where it is beyond Unicode."""
    short = F.regexp_replace(digits, "^0+", "")
    value = F.conv(F.concat(F.lit("0"), short), base, 10).cast("bigint")
    return F.when(F.length(short) <= 8, value)


def decode_entities(c) -> Column:
    """Named, decimal and hexadecimal character references, each read once."""
    names = F.from_json(F.lit(_names_json()), "map<string,map<string,string>>")
    legacy = F.from_json(F.lit(_legacy_json()), "map<string,string>")

    def replaced(p, body):
        rest = F.substring(p, F.length(body) + 1, F.length(p))
        closed = F.startswith(rest, F.lit(";"))
        after = F.when(closed, F.substring(rest, F.lit(2), F.length(rest))).otherwise(rest)
        whole = F.when(closed, F.try_element_at(F.try_element_at(names, F.substring(body, 1, 1)), body))
        bare = [
            F.when(F.length(body) >= n, F.concat(
                F.try_element_at(legacy, F.substring(body, 1, n)), F.substring(p, F.lit(n + 1), F.length(p))))
            for n in LEGACY_LENGTHS
        ]
        return (
            F.when(body == "", F.concat(F.lit("&"), p))
            .when(F.lower(F.substring(body, 1, 2)) == "#x",
                  F.concat(_code_point(_number(F.substring(body, F.lit(3), F.length(body)), 16)), after))
            .when(F.startswith(body, F.lit("#")),
                  F.concat(_code_point(_number(F.substring(body, F.lit(2), F.length(body)), 10)), after))
            .otherwise(F.coalesce(F.concat(whole, after), *bare, F.concat(F.lit("&"), p)))
        )

    def piece(p):
        # the one-element array lets the pattern run once per reference
        body = F.regexp_extract(p, r"^(#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z][a-zA-Z0-9]*)", 1)
        slow = F.element_at(F.transform(F.array(body), lambda b: replaced(p, b)), 1)
        fast = F
        for name, char in COMMON.items():
            head = name + ";"
            fast = fast.when(
                F.startswith(p, F.lit(head)),
                F.concat(F.lit(char), F.substring(p, F.lit(len(head) + 1), F.length(p))),
            )
        return fast.otherwise(slow)

    # set &amp; aside first: it is the commonest and must not be read twice
    held = F.replace(c, F.lit("&amp;"), F.lit(_AMP))
    parts = F.transform(
        F.split(held, "&"), lambda p, i: F.when(i == 0, p).otherwise(piece(p))
    )
    return F.replace(F.array_join(parts, ""), F.lit(_AMP), F.lit("&"))


def html_to_text(c) -> Column:
    """Text nodes, each stripped, empty ones dropped, joined by one space."""
    raw = F.regexp_replace(F.coalesce(c, F.lit("")), _CDATA, f"{_BREAK}$1{_BREAK}")
    marked = decode_entities(F.regexp_replace(raw, _MARKUP, _BREAK))
    nodes = F.transform(F.split(marked, _BREAK), strip)
    return F.array_join(F.filter(nodes, lambda n: n != ""), " ")
