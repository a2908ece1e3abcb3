"""Sensitive-content rules as column expressions over whole texts.

The registries of reserved domains and secret-like names are this library's own.
Patterns keep to what both the JVM's engine and linear-time engines understand,
so the SQL of a rule can use the same ones; a rule looks for a cheap literal
before it runs a pattern over the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Header texts, credential shapes, street words, test cards and name endings that the rules must match.
PRIVATE_KEYS = ("PRIVATE KEY", "RSA PRIVATE KEY", "EC PRIVATE KEY", "DSA PRIVATE KEY", "OPENSSH PRIVATE KEY", "PGP PRIVATE KEY BLOCK")
STREETS = ("avenue", "boulevard", "circle", "court", "drive", "highway", "lane", "parkway", "place", "road", "street", "terrace", "trail", "way")
TEST_CARDS = ("4111111111111111", "4242424242424242", "5555555555554444")
GOVERNMENT_NAMES = ("government_id", "national_id", "passport", "ssn", "tax_id")
TELEPHONE_NAMES = ("mobile", "phone", "telephone")
PLACEHOLDERS = ("changeme", "example", "not-a-secret", "placeholder")
CREDENTIAL = "(^|[^A-Za-z0-9_-])((AKIA|ASIA)[A-Z0-9]{16}([^A-Z0-9]|$)|gh[pousr]_[A-Za-z0-9_-]{36}([^A-Za-z0-9_-]|$)|github_pat_[A-Za-z0-9_-]{22}|AIza[A-Za-z0-9_-]{35}([^A-Za-z0-9_-]|$)|sk_live_[A-Za-z0-9_-]{16}|xox[baprs]-[A-Za-z0-9_-]{10})"

PEM = f"-----BEGIN ({'|'.join(PRIVATE_KEYS)})-----"
CREDENTIALED_URL = "://[^/\\\\ \t\r\n'\":@]+:[^/\\\\ \t\r\n'\"@]+@"
WS = "[ \t\r\f]*"
FRAGMENT = "[rRbBuUfF]{0,2}(?:'''(?:[^'\\\\]|'[^'\\\\]|''[^'\\\\]|'{0,2}\\\\[^\n])*'''|\"\"\"(?:[^\"\\\\]|\"[^\"\\\\]|\"\"[^\"\\\\]|\"{0,2}\\\\[^\n])*\"\"\"|'[^'\\\\]*(?:\\\\[^\n][^'\\\\]*)*'|\"[^\"\\\\]*(?:\\\\[^\n][^\"\\\\]*)*\")"
HEAD = f"^(?:[^=:]*[^A-Za-z0-9_=:])?([A-Za-z_][A-Za-z0-9_]*){WS}(?::[^=]*)?={WS}"
#: One pattern of a whole assignment, for engines that don't recurse over a group's repeats.
ASSIGNED = f"{HEAD}((?:{FRAGMENT}{WS})+)"
#: A literal that starts where the one before ended, in a line whose escaped quotes and backslashes are masked.
NEXT = "\\G([rRbBuUfF]{0,2}(?:'''[^\n]*?'''|\"\"\"[^\n]*?\"\"\"|'[^']*'|\"[^\"]*\"))" + WS
MASKS = (("\\\\", "\ufdd0"), ("\\'", "\ufdd1"), ('\\"', "\ufdd2"))  # noncharacters, which no text should hold
LOCAL = "[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]*\\z"
DOMAIN = "^[A-Za-z0-9.-]*"
DIALLED = "^[0-9 ()-]*"
DIALLED_VALUE = "^[0-9 ()+-]+\\z"
SSN = "(00[1-9]|0[1-9][0-9]|[1-578][0-9][0-9]|6[0-57-9][0-9]|66[0-57-9])-(0[1-9]|[1-9][0-9])-(000[1-9]|00[1-9][0-9]|0[1-9][0-9][0-9]|[1-9][0-9][0-9][0-9])"
ALONE_SSN = f"(^|[^0-9]){SSN}([^0-9]|$)"
ADDRESS_START = "^[ \t\r\f]*[0-9]+([ \t\r\f]|$)"
STREET = f"(?i)(^|[^A-Za-z0-9])({'|'.join(STREETS)})([^A-Za-z0-9]|$)"
POSTAL_CODE = "(^|[^0-9])[0-9]{5,6}([^0-9]|$)"
LONG_TOKEN = "[A-Za-z0-9]{15,}"
IBAN = "^[A-Za-z]{2}[0-9]{2}[A-Za-z0-9]{11,30}$"
RESERVED_DOMAINS = ("example", "example.com", "example.net", "example.org", "invalid", "localhost")
RESERVED = f"^(.*[.])?({'|'.join(RESERVED_DOMAINS).replace('.', '[.]')})$"
SECRET_NAMES = ("password", "passwd", "secret", "token", "api_key", "client_secret", "access_key")


def ending(endings: tuple[str, ...]) -> str:
    return f"^(.*_)?({'|'.join(endings)})$"


def named(name: Column, endings: tuple[str, ...]) -> Column:
    """A lower-cased name is one of ``endings`` or ends with an underscore and one."""
    return name.rlike(ending(endings))


def assignments(t: Column) -> Column:
    """``name`` (lower-cased) and ``value`` of the lines that assign string literals; adjacent literals are one value."""
    lines = F.filter(F.split(t, "\n"), lambda x: F.contains(x, F.lit("=")) & (F.contains(x, F.lit("'")) | F.contains(x, F.lit('"'))))
    found = F.transform(F.transform(lines, _masked), lambda x: F.struct(F.lower(F.regexp_extract(x, HEAD, 1)).alias("name"), F.regexp_extract_all(F.regexp_replace(x, HEAD, ""), F.lit(NEXT), F.lit(1)).alias("run")))
    found = F.filter(found, lambda p: (p["name"] != "") & (F.size(p["run"]) > 0))
    return F.transform(found, lambda p: F.struct(p["name"].alias("name"), _plain(F.array_join(F.transform(p["run"], _inner), "")).alias("value")))


def _masked(x: Column) -> Column:
    for escape, mask in MASKS:
        x = F.replace(x, F.lit(escape), F.lit(mask))
    return x


def _plain(x: Column) -> Column:
    for escape, mask in MASKS:
        x = F.replace(x, F.lit(mask), F.lit(escape))
    return x


def _inner(fragment: Column) -> Column:
    quoted = F.regexp_replace(fragment, "^[rRbBuUfF]{0,2}", "")
    n = F.when((quoted.startswith("'''") | quoted.startswith('"""')) & (F.length(quoted) >= 6), 3).otherwise(1)
    return F.substring(quoted, n + 1, F.length(quoted) - 2 * n)


def char_classes(x: Column) -> Column:
    return sum((x.rlike(p).cast("int") for p in ("[A-Z]", "[0-9]", "[^A-Za-z0-9]")), x.rlike("[a-z]").cast("int"))


def entropy(x: Column) -> Column:
    """Shannon entropy of the bytes in bits."""
    pairs = F.array_sort(F.regexp_extract_all(F.hex(x.cast("binary")), F.lit(".."), F.lit(0)))
    n = F.size(pairs).cast("double")
    share = F.transform(F.array_distinct(pairs), lambda c: F.size(F.filter(pairs, lambda o: o == c)) / n)
    return F.aggregate(F.array_sort(share), F.lit(0.0), lambda s, p: s - p * F.log2(p))


def high_entropy(v: Column) -> Column:
    return F.octet_length(v).between(20, 256) & (char_classes(v) >= 3) & (entropy(v) >= 3.5)


def secret_name(name: Column) -> Column:
    return named(F.lower(name), SECRET_NAMES)


def weak_secret(v: Column) -> Column:
    return (F.octet_length(v) >= 8) & ~F.lower(v).isin(*PLACEHOLDERS) & ~high_entropy(v)


def address(v: Column) -> Column:
    return v.rlike(ADDRESS_START) & v.rlike(STREET)


def dialled(v: Column) -> Column:
    return v.rlike(DIALLED_VALUE) & F.length(F.regexp_replace(v, "[^0-9]", "")).between(10, 15)


def private_key(t: Column) -> Column:
    return F.contains(t, F.lit("-----BEGIN ")) & t.rlike(PEM)


def provider_credential(t: Column) -> Column:
    return t.rlike(CREDENTIAL)


def credentialed_url(t: Column) -> Column:
    return F.contains(t, F.lit("://")) & t.rlike(CREDENTIALED_URL)


def telephone(t: Column) -> Column:
    """A plus sign after no letter or digit, and 10 to 15 digits among spaces, hyphens and brackets."""
    parts = F.split(t, "[+]")
    ok = lambda a, b: ~a.rlike("[A-Za-z0-9]$") & F.length(F.regexp_replace(F.regexp_extract(b, DIALLED, 0), "[^0-9]", "")).between(10, 15)
    return F.contains(t, F.lit("+")) & F.exists(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: ok(F.right(F.get(parts, i - 1), F.lit(1)), F.get(parts, i)))


def government_id(t: Column) -> Column:
    return t.rlike(ALONE_SSN)


def card(digits: Column) -> Column:
    return F.length(digits).between(13, 19) & ~digits.rlike("^(0+|1+|2+|3+|4+|5+|6+|7+|8+|9+)$") & F.call_function("luhn_check", digits) & ~digits.isin(*TEST_CARDS)


def payment_account(t: Column) -> Column:
    """A card number of 13 to 19 digits that stands alone, no test card, or an IBAN."""
    runs = F.regexp_extract_all(F.regexp_replace(t, "[A-Za-z][0-9]+", "a"), F.lit("[0-9][0-9 -]{12,}[A-Za-z]?"), F.lit(0))
    digits = F.transform(F.filter(runs, lambda m: ~m.rlike("[A-Za-z]$")), lambda m: F.regexp_replace(m, "[^0-9]", ""))
    codes = F.filter(F.regexp_extract_all(t, F.lit(LONG_TOKEN), F.lit(0)), lambda c: c.rlike(IBAN))
    return (t.rlike("[0-9][0-9 -]{12}") & F.exists(digits, card)) | F.exists(codes, iban)


def personal_email(t: Column) -> Column:
    """What stands around each at sign is a mail address whose domain is not reserved."""
    parts = F.split(t, "@")

    def personal(i: Column) -> Column:
        local = F.regexp_extract(F.right(F.get(parts, i - 1), F.lit(65)), LOCAL, 0)
        domain = F.lower(F.regexp_extract(F.left(F.get(parts, i), F.lit(254)), DOMAIN, 0))
        bad = lambda x: x.startswith(".") | x.endswith(".") | F.contains(x, F.lit(".."))
        return F.length(local).between(1, 64) & ~bad(local) & (F.length(domain) <= 253) & F.contains(domain, F.lit(".")) & ~bad(domain) & ~domain.rlike(RESERVED)

    return F.contains(t, F.lit("@")) & F.exists(F.sequence(F.lit(1), F.size(parts) - 1), personal)


def iban(x: Column) -> Column:
    """Whether a code of 15 to 34 characters, in either case, leaves 1 modulo 97 with its first four at the end and letters as numbers."""
    up = F.upper(x)
    turned = F.concat(F.substr(up, F.lit(5)), F.substring(up, 1, 4))
    digit = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), lambda s, c: (s * F.when(c.rlike("[0-9]"), 10).otherwise(100) + digit(c)) % 97)
    return x.rlike(IBAN) & (rest == 1)


def _any(rule: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
    return lambda t, pairs: F.exists(pairs, lambda p: rule(p["name"], p["value"]))


#: Rules over the name and value of one assignment, that read nothing else.
BY_ASSIGNMENT = {
    "HIGH_ENTROPY_NAMED_SECRET": lambda n, v: named(n, SECRET_NAMES) & high_entropy(v),
    "POSTAL_ADDRESS": lambda n, v: address(v) & v.rlike(POSTAL_CODE),
    "POSSIBLE_GOVERNMENT_IDENTIFIER": lambda n, v: named(n, GOVERNMENT_NAMES) & (F.length(F.regexp_replace(v, "[^0-9]", "")) >= 8) & ~v.rlike(SSN),
    "POSSIBLE_NAMED_SECRET": lambda n, v: named(n, SECRET_NAMES) & weak_secret(v),
    "POSSIBLE_POSTAL_ADDRESS": lambda n, v: address(v) & ~v.rlike(POSTAL_CODE),
}
#: Rules over (text, assignments) by what they confirm.
CONFIRMED = {
    "PRIVATE_KEY_PEM": lambda t, _: private_key(t), "PROVIDER_CREDENTIAL": lambda t, _: provider_credential(t), "CREDENTIALED_URL": lambda t, _: credentialed_url(t),
    "HIGH_ENTROPY_NAMED_SECRET": _any(BY_ASSIGNMENT["HIGH_ENTROPY_NAMED_SECRET"]),
    "TELEPHONE_NUMBER": lambda t, p: telephone(t) | _any(lambda n, v: named(n, TELEPHONE_NAMES) & dialled(v))(t, p),
    "GOVERNMENT_IDENTIFIER": lambda t, _: government_id(t), "PAYMENT_ACCOUNT_IDENTIFIER": lambda t, _: payment_account(t), "PERSONAL_EMAIL": lambda t, _: personal_email(t),
    "POSTAL_ADDRESS": _any(BY_ASSIGNMENT["POSTAL_ADDRESS"]),
}
UNCERTAIN = {k: _any(BY_ASSIGNMENT[k]) for k in ("POSSIBLE_GOVERNMENT_IDENTIFIER", "POSSIBLE_NAMED_SECRET", "POSSIBLE_POSTAL_ADDRESS")}


def with_assignments(docs: DataFrame, name: str = "assigned", text_col: str = "text") -> DataFrame:
    """``docs`` with the text's assignments, found once for all rules that read them."""
    return docs.withColumn(name, F.coalesce(assignments(F.col(text_col)), F.array().cast("array<struct<name: string, value: string>>")))


def verdict(docs: DataFrame, text_col: str = "text", each: bool = False) -> DataFrame:
    """``docs`` with ``status`` and the sorted ``rules`` of the winning class; with ``each``, a rule of ``BY_ASSIGNMENT`` stands once for every assignment it finds."""
    t, pairs = F.col(text_col), F.col("assigned")

    def times(k: str, f: Callable[[Column, Column], Column]) -> Column:
        if each and k in BY_ASSIGNMENT:
            return F.size(F.filter(pairs, lambda p: BY_ASSIGNMENT[k](p["name"], p["value"])))
        return F.when(f(t, pairs), 1).otherwise(0)

    hits = lambda rules: F.array_sort(F.flatten(F.array(*[F.array_repeat(F.lit(k), times(k, f)) for k, f in rules.items()])))
    found = with_assignments(docs, "assigned", text_col).withColumns({"sure": hits(CONFIRMED), "maybe": hits(UNCERTAIN)})
    status = F.when(F.size("sure") > 0, "REJECTED").when(F.size("maybe") > 0, "QUARANTINED").otherwise("ACCEPTED")
    return found.withColumns({"status": status, "rules": F.when(F.size("sure") > 0, F.col("sure")).otherwise(F.col("maybe"))}).drop("assigned", "sure", "maybe")
