"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, digits and plus
signs before them, address schemes, and words that announce an identifier. From
each anchor a parser of that kind expands to the boundaries of the value and
validates it. A parser only moves right of what its kind has already taken, so
the work stays linear in the text.
"""

import hashlib
import re
import string
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Span = tuple[int, int]
Parser = Callable[[str, int, int], tuple[Span | None, int]]

BASE_KINDS = ["email", "ip", "card", "phone"]
# In the order in which spans that start together are listed.
KINDS = [*BASE_KINDS, "url", "iban", "account", "secret"]

SCHEMES = ["http://", "https://", "ftp://", "mailto:"]
ACCOUNT_CUES = ["account", "acct", "customer", "passport", "ssn", "user", "login", "konto"]
ACCOUNT_CUES += ["password", "passwort", "kennwort", "token", "secret", "api_key", "apikey", "api key", "api-key"]
IBAN_CUE = "iban"

LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]++(?:\.[0-9]+){3}")
DIGITS = re.compile(r"[0-9]+")
DIGIT_RUN = re.compile(r"[0-9](?:[ -]?[0-9])*+")
PHONE_RUN = re.compile(r"\+[0-9][ ().0-9-]+")
URL = re.compile(r"[^\s<>\"'`{}|\\^]+")
ACCOUNT = re.compile(
    r"(?i:[ _-]?(?:number|name|no\.?|nr\.?|id|key))?[ \t]{0,3}[:=#][ \t]{0,3}\"?([A-Za-z0-9][A-Za-z0-9_./+-]{3,}+)"
)
# Without a sign of assignment only a number is taken for a value.
ACCOUNT_NUMBER = re.compile(r"(?i:[ _-]?(?:number|no\.?|nr\.?|id))?[ \t]{1,3}([0-9]++(?:[./-][0-9]++)*+)")
ACCOUNT_NUMBER_DIGITS = 6
IBAN = re.compile(r"[ :=#]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
# What secrets of common services begin with, and how they go on.
SECRETS = {
    "AKIA": r"[0-9A-Z]{16}", "ASIA": r"[0-9A-Z]{16}", "ghp_": r"[0-9A-Za-z]{36,}", "xoxb-": r"[0-9A-Za-z-]{20,}",
    "Bearer ": r"[0-9A-Za-z_.~+/-]{20,}=*", "-----BEGIN ": r"(?:[A-Z]+ )*PRIVATE KEY-----",
}
SECRET = re.compile("|".join(f"{re.escape(start)}{rest}" for start, rest in SECRETS.items()))
ALNUM = frozenset(string.ascii_letters + string.digits)
# Characters of an account number by country, from the register of the standard.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _email(text: str, at: int, taken: int) -> tuple[Span | None, int]:
    """Anchor: the at-sign. Left over the local part, right over the labels."""
    start = at
    while start > taken and text[start - 1] in LOCAL:
        start -= 1
    host = HOST.match(text, at + 1) if start < at else None
    return ((start, host.end()), host.end()) if host else (None, taken)


def _ip(text: str, at: int, taken: int) -> tuple[Span | None, int]:
    """Anchor: the first digit of a number. Four numbers, each at most 255."""
    quad = QUAD.match(text, at)
    if not quad:
        return None, DIGITS.match(text, at).end()
    parts = [p.lstrip("0") for p in quad.group().split(".")]
    fits = all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)
    return (quad.span() if fits else None), quad.end()


def _card(text: str, at: int, taken: int) -> tuple[Span | None, int]:
    """Anchor: the first digit of a run that single blanks and hyphens may part."""
    run = DIGIT_RUN.match(text, at)
    digits = run.group().replace(" ", "").replace("-", "")
    fits = 14 <= len(digits) <= 19 and luhn(digits)
    return (run.span() if fits else None), run.end()


def _phone(text: str, at: int, taken: int) -> tuple[Span | None, int]:
    """Anchor: a plus sign and a digit. Right to the last digit of the run."""
    run = PHONE_RUN.match(text, at)
    if not run:
        return None, at + 1
    end = run.end()
    while not "0" <= text[end - 1] <= "9":
        end -= 1
    if end < at + 4:
        return None, at + 1
    digits = sum("0" <= c <= "9" for c in text[at:end])
    return ((at, end) if 10 <= digits <= 15 else None), end


def _url(text: str, at: int, taken: int) -> tuple[Span | None, int]:
    """Anchor: a scheme. Right to a blank or quote, less closing punctuation."""
    body = URL.match(text, at)
    end = at + len(body.group().rstrip(".,;:!?)]"))
    scheme = text.index(":", at) + 1
    return ((at, end) if end > scheme + 2 else None), body.end()


def _iban(text: str, at: int, taken: int) -> tuple[Span | None, int]:
    """Anchor: the end of the cue, or a country code. Check digits, remainder 1 by 97.

    What follows may look like another group, so the value is tried at the
    length its country states first, then as far as it goes; without a stated
    length at every end of a group.
    """
    found = IBAN.match(text, at)
    if not found or (found.start(1) and text[found.start(1) - 1] in ALNUM):
        return None, at
    start, last = found.span(1)
    places = [i for i in range(start, last) if text[i] != " "]
    code = "".join(text[i] for i in places)
    stated = IBAN_LENGTHS.get(code[:2])
    lengths = range(len(code), 14, -1) if stated is None else (stated, len(code))
    for length in lengths:
        if length > len(code):
            continue
        end = places[length - 1] + 1
        if text[end : end + 1] in ALNUM:
            continue
        value = "".join(str(int(c, 36)) for c in code[4:length] + code[:4])
        if int(value) % 97 == 1:
            return (start, end), end
    return None, at


def _account(text: str, at: int, taken: int) -> tuple[Span | None, int]:
    """Anchor: the end of the cue. A sign of assignment, then a value with a digit; or a number."""
    found = ACCOUNT.match(text, at)
    if not found:
        number = ACCOUNT_NUMBER.match(text, at)
        if not number or text[number.end() : number.end() + 1] in ALNUM:
            return None, at
        digits = sum("0" <= c <= "9" for c in number.group(1))
        return (number.span(1) if digits >= ACCOUNT_NUMBER_DIGITS else None), number.end()
    start, end = found.span(1)
    while text[end - 1] in "./+-":
        end -= 1
    fits = any("0" <= c <= "9" for c in text[start:end])
    return ((start, end) if fits else None), found.end()


def _secret(text: str, at: int, taken: int) -> tuple[Span | None, int]:
    """Anchor: what secrets of a service begin with. As many characters as they have."""
    found = SECRET.match(text, at)
    if not found or (at and text[at - 1] in ALNUM) or text[found.end() : found.end() + 1] in ALNUM:
        return None, at
    return found.span(), found.end()


# Kind, parser, and whether it starts where the anchor starts or where it ends.
PARSERS: dict[str, list[tuple[str, Parser, bool]]] = {
    "at": [("email", _email, True)],
    "digit": [("ip", _ip, True), ("card", _card, True)],
    "plus": [("phone", _phone, True)],
    "scheme": [("url", _url, True)],
    "iban": [("iban", _iban, False)],
    "country": [("iban", _iban, True)],
    "cue": [("account", _account, False)],
    "start": [("secret", _secret, True)],
}


@cache
def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    words = [("@", "at")]
    words += [(d, "digit") for d in string.digits]
    words += [(f"+{d}", "plus") for d in string.digits]
    words += [(country, "country") for country in IBAN_LENGTHS]
    words += [(start, "start") for start in SECRETS]
    for kind, names in (("scheme", SCHEMES), ("iban", [IBAN_CUE]), ("cue", ACCOUNT_CUES)):
        for name in names:
            words += [(w, kind) for w in (name, name.capitalize(), name.upper())]
    for word, kind in words:
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, place of the kind in KINDS, end)`` in order."""
    taken = dict.fromkeys(KINDS, 0)
    spans = []
    for last, (anchor, length) in anchors().iter(text):
        for kind, parse, at_start in PARSERS[anchor]:
            at = last - length + 1 if at_start else last + 1
            if at < taken[kind]:
                continue
            span, taken[kind] = parse(text, at, taken[kind])
            if span:
                spans.append((span[0], KINDS.index(kind), span[1]))
    return sorted(spans)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


def personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: counts of the base kinds and all spans of its whole text.

    Spans are ``kind:start:end`` in code points, end exclusive. Within a kind
    they do not overlap; kinds may. Null texts count as empty and have no spans;
    null ids and repeated rows pass through; an empty table gives an empty
    result; columns beside id and text are not read.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[str, list] = {f"n_{k}": [] for k in BASE_KINDS}
            out |= {"base_sha256": [], "spans": []}
            for text in batch["text"]:
                spans = find_spans(text)
                base = [s for s in spans if s[1] < len(BASE_KINDS)]
                for place, kind in enumerate(BASE_KINDS):
                    out[f"n_{kind}"].append(sum(s[1] == place for s in base))
                out["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
                out["spans"].append(listed(spans))
            yield pd.DataFrame({"doc_id": batch["doc_id"], **out})

    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return docs.select(
        F.col(id_column).cast("string").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    ).mapInPandas(
        scan, f"doc_id string, {counts}, base_sha256 string, spans string"
    ).withColumn("doc_id", F.col("doc_id").cast("long"))
