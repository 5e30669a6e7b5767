"""Check digits of bank, card and insurance numbers.

The functions take and return SQL text, because the detection rules are
assembled as one SQL expression: building it from text costs a few
milliseconds, building it column by column costs thousands of calls.
"""

from __future__ import annotations


def digits(v: str) -> str:
    """Only the ASCII digits of ``v``."""
    return f"regexp_replace({v}, '[^0-9]+', '')"


def digit_count(v: str) -> str:
    return f"char_length({digits(v)})"


def luhn_ok(v: str) -> str:
    """Luhn check over the digits of ``v``; without any digit it fails."""
    return f"({digits(v)} <> '' AND luhn_check({digits(v)}))"


def aba_ok(v: str) -> str:
    """Nine digits whose 3-7-1 weighted sum is a multiple of ten."""
    weighted = " + ".join(
        f"{(3, 7, 1)[i % 3]} * try_cast(substring({v}, {i + 1}, 1) AS INT)" for i in range(9)
    )
    return f"(char_length({v}) = 9 AND ({weighted}) % 10 = 0)"


def iban_ok(v: str) -> str:
    """Mod-97 check of an IBAN; blanks are ignored.

    A digit appends one decimal place, a letter (10 to 35) appends two.
    """
    bare = f"replace({v}, ' ', '')"
    return (
        f"(char_length({bare}) BETWEEN 15 AND 34 AND aggregate("
        f"split(concat(substr({bare}, 5), left({bare}, 4)), ''), 0, (acc, c) -> "
        "CASE WHEN c BETWEEN '0' AND '9' THEN (acc * 10 + ascii(c) - 48) % 97 "
        "ELSE (acc * 100 + ascii(c) - 55) % 97 END) = 1)"
    )
