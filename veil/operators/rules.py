"""Detection rules, one or more per operator.

A rule is a pattern with one capture group, the literals that must occur in
the text for the pattern to be worth running, and a check of the captured
value. Patterns use no look-around and no back references, so they mean the
same to every regular-expression engine and cannot backtrack far: each
repetition that may meet long input is bounded or a plain character class.

A pattern consumes the character in front of the value (so a value never
starts inside a word or number) but nothing behind it. It takes the whole run
of digits instead and leaves it to the check to refuse a run of wrong length;
otherwise two values separated by one blank would hide each other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from veil.functions.checksums import aba_ok, digit_count, digits, iban_ok, luhn_ok
from veil.functions.text import literal


@dataclass(frozen=True)
class Rule:
    operator: str
    pattern: str
    # Literals of which at least one must be in the text. Lower-case ones are
    # looked up in the lower-cased text, the others in the text as it is.
    needles: tuple[str, ...] = ()
    # SQL text of the check, given the SQL text of the value.
    check: Callable[[str], str] | None = None
    # Fewest digits a value has. Texts with fewer are spared; 0 means that the
    # value need not have digits at all.
    digits: int = 1
    # A piece of the pattern without its edges, much quicker to search for.
    hint: str | None = None


# Words between a cue and its number: "pin number is: 1234".
GAP = r"(?: number| no\.?| code| id)?(?: is| was|:|=|#){0,2} ?"
# What may stand in front of a cue word, and in front of a number.
WORD_EDGE = "(?:^|[^A-Za-z])"
NUMBER_EDGE = "(?:^|[^0-9])"

# A domain name has at most 127 labels.
DOMAIN = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}"
EMAIL = rf"([A-Za-z0-9][A-Za-z0-9._%+-]{{0,63}}@{DOMAIN})"
# With more than 64 characters before the "@": starts where the run of them starts,
# so that a long run without "@" is read once.
EMAIL_LONG = rf"(?:^|[^A-Za-z0-9._%+-])[._%+-]*([A-Za-z0-9][A-Za-z0-9._%+-]*@{DOMAIN})"
URL = (
    r"(?i)((?:(?:https?|ftps?|wss?|s3)://|www\.)"
    r"[^ \t\r\n<>\"]*[^ \t\r\n<>\".,;:!?'\)\]])"
)
IBAN_PLAIN = r"(?:^|[^A-Za-z0-9])([A-Z]{2}[0-9]{2}[A-Z0-9]{11,})"
IBAN_GROUPED = r"(?:^|[^A-Za-z0-9])([A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"
VIN = r"(?:^|[^A-Za-z0-9])([A-HJ-NPR-Z0-9]{17}[A-Za-z0-9]*)"
CARD_BODY = (
    r"(?:[0-9]{4}[ _-]){3}[0-9]+|[0-9]{4}[ _-][0-9]{6}[ _-][0-9]+|[0-9]{13,}"
)
CARD = rf"{NUMBER_EDGE}({CARD_BODY})"
CARD_CUED = (
    rf"(?i){WORD_EDGE}card{GAP}"
    r"((?:[0-9]{4}[ _-]){1,3}[0-9]+|[0-9]{4}[ _-][0-9]{6}[ _-][0-9]+|[0-9]{8,})"
)
EXPIRY = (
    rf"(?i){WORD_EDGE}(?:exp(?:iry|ires|iration)?(?: date)?|valid thru|valid until)"
    r"(?: is| on|:|\.){0,2} ?((?:0[1-9]|1[0-2])[/-][0-9]+)"
)
CVV = rf"(?i){WORD_EDGE}(?:cvv2?|cvc2?){GAP}([0-9]+)"
PIN = rf"(?i){WORD_EDGE}pin{GAP}([0-9]+)"
ITIN = r"(?:^|[^0-9-])(9[0-9]{2}-?[78][0-9]-?[0-9]+)"
SSN = r"(?:^|[^0-9-])([0-9]{3}-[0-9]{2}-[0-9]+)"
SSN_CUED = rf"(?i){WORD_EDGE}(?:ssn|social security){GAP}([0-9]{{3}} ?[0-9]{{2}} ?[0-9]+)"
SIN = rf"(?i){WORD_EDGE}(?:sin|social insurance){GAP}([0-9]{{3}}[ -]?[0-9]{{3}}[ -]?[0-9]+)"
ROUTING = rf"(?i){WORD_EDGE}(?:routing|aba){GAP}([0-9]+)"
HEALTH = (
    rf"(?i){WORD_EDGE}health(?: card| service| insurance)?{GAP}"
    r"([0-9]{4}[ -]?[0-9]{3}[ -]?[0-9]+)"
)
ACCOUNT = rf"(?i){WORD_EDGE}(?:account|acct){GAP}([0-9]+)"
SWIFT = r"(?i:swift|bic)(?i:(?: code)?(?: is|:){0,2}) ?([A-Z0-9]+)"
PHONE = (
    r"(?:^|[^0-9A-Za-z+_.-])((?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])"
    r"[0-9]{3}[ .-][0-9]+)"
)
PHONE_INTL = r"(?:^|[^0-9A-Za-z+])(\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}[0-9]*)"
PHONE_CUED = (
    rf"(?i){WORD_EDGE}(?:phone|call|mobile|tel|telephone|fax|cell){GAP}"
    r"(\+?[0-9]{3}[ .-]?[0-9]{4}|\+?[0-9]{7,})"
)
NAME = r"\p{Lu}[\p{L}'-]*"
PERSON = rf"(?:[Mm]y name is|[Tt]his is|(?:Mr|Mrs|Ms|Dr)\.?) ({NAME}(?: {NAME})*)"
PERSON_I_AM = rf"(?:^|[^A-Za-z])I(?: a|')m ({NAME}(?: {NAME})+)"
STREET = (
    r"(?:^|[^0-9])([0-9]{1,5} (?:\p{Lu}\p{L}+ )+"
    r"(?:Street|Avenue|Road|Boulevard|Lane|Drive|Court|Square))"
)
PLACE = rf"(?:live in|living in|located in|moved to|travel to) ({NAME}(?: {NAME})*)"
ZIP = rf"(?i){WORD_EDGE}zip{GAP}([0-9]{{5}}(?:-[0-9]{{4}})?[0-9]*)"
IPV4 = r"(?:^|[^0-9.])([0-9]+(?:\.[0-9]+){3,8})"
SECRET = r"(?i)(?:token|secret|api_key) ?[=:] ?\"?([0-9A-Za-z_-]{16,})"
ID_NUMBER = (
    rf"(?i){WORD_EDGE}(?:passport|driver license|driver licence|insurance|member){GAP}"
    r"([A-Z0-9][A-Z0-9-]{4,}[A-Z0-9])"
)
USER_NAME = (
    rf"(?i){WORD_EDGE}(?:username|user name|user id|account id)(?: is|:|=){{1,2}} ?"
    r"([A-Z0-9][A-Z0-9._-]+[A-Z0-9])"
)
# One digit, a separator, one digit, … : a number written apart to hide it.
SPACED = r"(?:^|[^0-9])([0-9](?:[ ._-][0-9]){6,}[0-9]*)"

IPV4_CHECK = (
    r"^(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    r"(?:\.(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"
)


def _digits_between(low: int, high: int) -> Callable[[str], str]:
    return lambda v: f"{digit_count(v)} BETWEEN {low} AND {high}"


def _length(*allowed: int) -> Callable[[str], str]:
    return lambda v: f"char_length({v}) IN ({', '.join(map(str, allowed))})"


def _like(pattern: str) -> Callable[[str], str]:
    return lambda v: f"rlike({v}, {literal(pattern)})"


def _all(*checks: Callable[[str], str]) -> Callable[[str], str]:
    return lambda v: " AND ".join(f"({c(v)})" for c in checks)


def _not(check: Callable[[str], str]) -> Callable[[str], str]:
    return lambda v: f"NOT ({check(v)})"


def is_itin(v: str) -> str:
    """Nine digits that start with 9 and have 7 or 8 in fourth place."""
    return f"rlike({digits(v)}, '^9[0-9]{{2}}[78][0-9]{{5}}$')"


_SPACED_ONLY = _like("^[0-9](?:[ ._-][0-9])+$")
_CARD_LENGTH = _digits_between(13, 19)
_NINE = _digits_between(9, 9)

RULES: tuple[Rule, ...] = (
    Rule("EMAIL_ADDRESS", EMAIL, ("@",), digits=0),
    Rule("EMAIL_ADDRESS", EMAIL_LONG, ("@",), lambda v: f"instr({v}, '@') > 65", digits=0,
         hint="[A-Za-z0-9._%+-]{64}@"),
    Rule("URL", URL, ("://", "www."), digits=0),
    Rule("IBAN_CODE", IBAN_PLAIN, (), iban_ok, digits=2, hint="[A-Z]{2}[0-9]{2}"),
    Rule("IBAN_CODE", IBAN_GROUPED, (), iban_ok, digits=2, hint="[A-Z]{2}[0-9]{2}"),
    Rule("VIN", VIN, (), _all(_length(17), _like("[A-Z]"), _like("[0-9]")),
         hint="[A-HJ-NPR-Z0-9]{17}"),
    Rule("CREDIT_CARD_NUMBER", CARD, (), _all(_CARD_LENGTH, luhn_ok), digits=13),
    Rule("CREDIT_CARD_NUMBER", CARD_CUED, ("card",), _digits_between(8, 19), digits=8),
    Rule("CREDIT_CARD_EXPIRY", EXPIRY, ("exp", "valid"),
         _like("[/-](?:[0-9]{2}|[0-9]{4})$"), digits=4),
    Rule("CREDIT_CARD_CVV", CVV, ("cvv", "cvc"), _length(3, 4), digits=3),
    Rule("PIN", PIN, ("pin",), _length(4), digits=4),
    Rule("US_ITIN", ITIN, (), is_itin, digits=9, hint="9[0-9]{2}-?[78]"),
    Rule("US_SSN", SSN, ("-",), _all(_length(11), _not(is_itin)), digits=9,
         hint="[0-9]-[0-9]{2}-[0-9]"),
    Rule("US_SSN", SSN_CUED, ("ssn", "social security"), _all(_NINE, _not(is_itin)), digits=9),
    Rule("CA_SIN", SIN, ("sin", "social insurance"), _all(_NINE, luhn_ok), digits=9),
    Rule("US_BANK_ROUTING_NUMBER", ROUTING, ("routing", "aba"), aba_ok, digits=9),
    Rule("CA_HEALTH_NUMBER", HEALTH, ("health",), _digits_between(10, 10), digits=10),
    Rule("US_BANK_ACCOUNT_NUMBER", ACCOUNT, ("account", "acct"), _digits_between(10, 12), digits=10),
    Rule("SWIFT_CODE", SWIFT, ("swift", "bic"),
         _like("^[A-Z]{6}[A-Z0-9]{2}(?:[A-Z0-9]{3})?$"), digits=0),
    Rule("PHONE_NUMBER", PHONE, (), _all(_digits_between(7, 15), _like("[ .-][0-9]{4}$")), digits=7,
         hint="[0-9]{3}[ .-][0-9]"),
    Rule("PHONE_NUMBER", PHONE_INTL, ("+",), _digits_between(7, 15), digits=7),
    Rule("PHONE_NUMBER", PHONE_CUED, ("phone", "call", "mobile", "tel", "fax", "cell"),
         _digits_between(7, 15), digits=7),
    Rule("PERSON", PERSON, ("my name is", "this is", "Mr", "Ms", "Dr"), digits=0),
    Rule("PERSON", PERSON_I_AM, ("I am", "I'm"), digits=0),
    Rule("LOCATION", STREET,
         ("Street", "Avenue", "Road", "Boulevard", "Lane", "Drive", "Court", "Square")),
    Rule("LOCATION", PLACE, ("live in", "living in", "located in", "moved to", "travel to"),
         digits=0),
    Rule("LOCATION", ZIP, ("zip",), _like("^[0-9]{5}(?:-[0-9]{4})?$"), digits=5),
    Rule("DEFAULT", IPV4, (".",), _like(IPV4_CHECK), digits=4, hint="[0-9]\\.[0-9]"),
    Rule("DEFAULT", SECRET, ("token", "secret", "api_key"), digits=0),
    # A well-formed card number that fails its check digit and has no cue.
    Rule("DEFAULT", CARD, (), _all(_CARD_LENGTH, _not(luhn_ok)), digits=13),
    Rule("DEFAULT", ID_NUMBER, ("passport", "licen", "insurance", "member"), _like("[0-9]")),
    Rule("DEFAULT", USER_NAME, ("username", "user name", "user id", "account id"),
         digits=0),
)

# Second pass: numbers whose digits were written apart.
SPACED_RULES: tuple[Rule, ...] = (
    Rule("CREDIT_CARD_NUMBER", SPACED, (), _all(_SPACED_ONLY, _CARD_LENGTH, luhn_ok), digits=13),
    Rule("US_ITIN", SPACED, (), _all(_SPACED_ONLY, is_itin), digits=9),
    Rule("US_SSN", SPACED, (), _all(_SPACED_ONLY, _NINE, _not(is_itin)), digits=9),
    Rule("PHONE_NUMBER", SPACED, (), _all(
        _SPACED_ONLY, lambda v: f"{digit_count(v)} IN (7, 8, 10, 11, 12, 13, 14, 15)"), digits=7),
    # Too long for all of these, or as long as a card but with a wrong check digit.
    Rule("DEFAULT", SPACED, (), _all(
        _SPACED_ONLY, lambda v: f"{digit_count(v)} > 15", _not(_all(_CARD_LENGTH, luhn_ok))), digits=16),
)

# Patterns of several rules, run once for all of them: name of the column that
# holds the hits, pattern, fewest digits, hint.
SHARED: tuple[tuple[str, str, int, str], ...] = (
    ("card", CARD, 13, "[0-9]{4}"),
    ("spaced", SPACED, 7, "[0-9][ ._-][0-9][ ._-][0-9]"),
)

# What a line has in which any rule finds a value: a digit, an "@", or a cue with what its
# pattern wants behind it. Cues are cut off before a rare letter, one class for all of them,
# and sorted by the letter after it, so that most characters of a text cost one look-up.
CUED = (
    r"[0-9@:WwBbKkCcUuMDIvhy](?:(?<=[0-9@])|//"
    r"|[WwIiOoSs](?i:w\.|ft|unt id|er(?: ?name| id)|c(?: code| is|:| ?(?-i:[A-Z0-9])))"
    r"|[EeRr](?i:[ny]|et) ?[=:]"
    r"|[rs' iea](?:(?<=[MD][rs])s?\.?|(?<=I[ '])a?m|(?<=hi)s is|(?<=y )name is"
    r"|(?<=v[ei])(?: in|ng in|d to|l to)|(?<=ca)ted in) \p{Lu})"
)

# What is never personal data (fixed values).
DEVICE_WORDS = (
    "thermostat", "smartplug", "camera", "fan", "light", "lamp", "sensor", "ipad",
    "tv", "laundry machine", "refrigerator", "air conditioning", "microwave", "door",
    "curtains", "dehumidifier", "ring bell", "device",
)
UNIT_WORDS = (
    "fahrenheit", "celsius", "kelvin", "degrees", "meters", "kilograms", "liters",
    "inches", "feet", "pounds", "grams", "watts", "volts",
)
LANGUAGE_WORDS = (
    "english", "french", "german", "spanish", "italian", "portuguese", "dutch",
    "chinese", "japanese", "korean", "arabic", "hindi", "russian", "polish",
)
ROOM_WORDS = (
    "kitchen", "bedroom", "bathroom", "living room", "dining room", "guest room", "laundry room",
    "hall", "hallway", "office", "garage", "garden", "basement", "attic", "balcony", "porch",
    "patio", "nursery", "front", "back", "upstairs", "downstairs", "ceiling", "floor", "desk",
)
ALLOWED_WORDS = DEVICE_WORDS + UNIT_WORDS + LANGUAGE_WORDS
# Time of day, a temperature or measurement, a timestamp, a name of a device with
# nothing but its rooms or an article in front ("kitchen light", not "Anna Light").
ALLOWED_SHAPES = (
    r"(?i)^(?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9])?(?: ?[ap]\.?m\.?)?$"
    r"|^-?[0-9]+(?:\.[0-9]+)? ?(?:°|degrees|c|f|k|m|cm|mm|km|kg|g|l|ml|w|kw|v)(?: ?[cfk])?$"
    r"|^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[t ][0-9:.]+z?)?$"
    r"|^(?:(?:the|an?|my|our|your|this|that) )?(?:(?:" + "|".join(ROOM_WORDS) + r") )*"
    r"(?:" + "|".join(DEVICE_WORDS) + r")s?$"
)
