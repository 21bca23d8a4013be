"""Format-preserving pseudonyms for personal data: a keyed Feistel permutation inside each value's own format.

Kinds and their checks: e-mail addresses (local part permuted, domain kept), payment cards (13 to 19 digits, Luhn; the
check digit is computed anew), IBANs (mod 97; check digits computed anew), US social security numbers (no area 000, 666
or 9xx, no group 00, no serial 0000), phone numbers (international or with a bracketed or separated area code; the
country code stays), IPv4 and full IPv6 addresses, and calendar dates from 1900 to 2099 as Y-M-D, D.M.Y or M/D/Y.
Candidates are looked for at every place of the text, also inside one another: IBANs by the length of their country, cards
at every border of a group from long to short, phone numbers up to the length of their country and never into a dotted
quad. What passes its check counts, from left to right; what fails its check takes nothing from what lies in it. Digits remain digits, letters keep their case, separators stay, and each
pseudonym passes the check of its kind. Only an IPv4 address may change its length, as its octets are written plainly.

A value is a row of symbols, each with its own radix. The network splits the row in two halves and in each round adds to
one half, symbol by symbol, digits of a keyed hash of the other half. Adding is undone by subtracting, so the map is a
permutation of the values of that format: equal values get equal pseudonyms in every document and different values
different ones. Separators are not part of the value. Very small formats (an e-mail of two letters) have few values, so
the permutation hides little there; that is inherent.

Main path: one pass of SQL expressions in each row, no shuffle, no Python; texts without a candidate are returned as
they are. Defined cases: null text stays null, empty text stays empty, an empty table gives an empty result, repeated
rows get the same output; columns of other names, whatever they are, are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

#: Length of the IBANs of a country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE BI", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BJ BF CF CG CI CM DJ FR GA GQ GR IT KM MC MG ML MR NE SM SN TD TG DZ MA MZ AO CV GW", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: 27 letters and digits hold for most, these differ.
IBAN_LENGTHS_28 = "BJ BF CI ML SN TG HN"
#: Digits after the country code, least and most; for codes that are not listed, whatever 15 digits leave.
PHONE_LENGTHS = {
    (10, 10): "1 7 52 57 90 91 30 98 63 92", (9, 9): "33 34 41 48 61 351 420 421 27 56 51 380 212 213 966", (8, 8): "45 47 65 852 371 372 370 502 503 504 505 507",
    (9, 10): "44 31 81 20 66 40", (8, 9): "32 36 972 971 353 385 386 359 593", (7, 10): "46 64 60", (8, 11): "82 84 62", (10, 11): "55 86 54", (6, 11): "49 43 39 358",
}


def _iban_body() -> str:
    by_length = {n: [c for c in codes.split() if n != 27 or c not in IBAN_LENGTHS_28] for n, codes in IBAN_LENGTHS.items()}
    by_length[28] = sorted({*by_length[28], *IBAN_LENGTHS_28.split()})
    listed = "|".join(c for codes in by_length.values() for c in codes)
    national = [f"(?:{'|'.join(codes)})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in by_length.items()]
    other = rf"(?!{listed})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
    return "(?:" + "|".join([*national, other]) + ")"


def _phone_body() -> str:
    quad = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
    digit = rf"(?:(?: (?!{quad})|[.-])?[0-9])"

    def national(least: int, most: int) -> str:
        area = [rf"\([0-9]{{{k}}}\){digit}{{{max(least - k, 1)},{most - k}}}" for k in (1, 2, 3, 4)]
        return rf"(?:[ .-]?(?:\(0\){digit}{{{least},{most}}}|{'|'.join(area)})|{digit}{{{least},{most}}})"

    listed = "|".join(c for codes in PHONE_LENGTHS.values() for c in codes.split())
    ways = [rf"(?:{'|'.join(codes.split())}){national(*n)}" for n, codes in PHONE_LENGTHS.items()]
    # numbers shorter than their country's usual ones, and countries that are not listed
    ways += [rf"(?:{'|'.join(codes.split())}){national(5, n[0] - 1)}" for n, codes in PHONE_LENGTHS.items() if n[0] > 5]
    ways += [rf"(?!{listed})[1-9][0-9]{{{k}}}{national(5, 14 - k)}" for k in (2, 1, 0)]
    return rf"(?:\+(?:{'|'.join(ways)})|\([0-9]{{3}}\) ?[0-9]{{3}}[ .-][0-9]{{4}}|[0-9]{{3}}[.-][0-9]{{3}}[.-][0-9]{{4}})"


#: What stands before, the candidate, and what stands behind it, in the order in which kinds are tried at a place.
PATTERNS = {
    "email": ("(?<![0-9A-Za-z])", r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}", ""),
    "ipv6": ("(?<![0-9A-Za-z:])", r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}", "(?![0-9A-Za-z:])"),
    "iban": ("(?<![0-9A-Za-z])", _iban_body(), "(?![0-9A-Za-z])"),
    "date": (
        "(?<![0-9A-Za-z./-])",
        r"(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2})",
        "(?![0-9A-Za-z]|[./-][0-9])",
    ),
    "ipv4": ("(?<![0-9A-Za-z.])", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", r"(?![0-9A-Za-z]|\.[0-9])"),
    "ssn": ("(?<![0-9A-Za-z-])", "[0-9]{3}-[0-9]{2}-[0-9]{4}", "(?![0-9A-Za-z]|-[0-9])"),
    "phone": ("(?<![0-9A-Za-z+])", _phone_body(), "(?![0-9A-Za-z])"),
    "card": ("(?<![0-9A-Za-z])", "[0-9](?:[ -]?[0-9]){12,18}", "(?![0-9A-Za-z])"),
}
#: Cheap test for a text that may hold a candidate: e-mail addresses have an @, IPv6 addresses a colon, all others a digit.
HINT = "[@:0-9]"

DIGITS, LOWERS, UPPERS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def feistel(values: Column, radices: Column, key: str, kind: str) -> Column:
    """The permuted symbols. ``values`` and ``radices`` are arrays of long of the same length."""

    def merge(state: Column, round_: Column) -> Column:
        return F.when(round_ % 2 == 0, keyed_step(state, round_, True)).otherwise(keyed_step(state, round_, False))

    def keyed_step(state: Column, round_: Column, even: bool) -> Column:
        n = F.size(state)
        cut = (n / 2).cast("int")
        left, right = F.slice(state, 1, cut), F.slice(state, cut + 1, n - cut)
        moved, fixed = (right, left) if even else (left, right)
        seed = F.concat_ws("|", F.lit(f"{key}|{kind}"), round_.cast("string"), F.array_join(F.transform(fixed, lambda x: x["v"]), ","))
        changed = bind(
            seed,
            lambda h: F.transform(
                moved,
                lambda v, i: F.struct(
                    F.pmod(
                        v["v"] + F.conv(F.substring(F.sha2(F.concat_ws("|", h, i.cast("string")), 256), 1, 12), 16, 10).cast("long"),
                        v["r"],
                    ).alias("v"),
                    v["r"].alias("r"),
                ),
            ),
        )
        return F.concat(left, changed) if even else F.concat(changed, right)

    start = F.arrays_zip(values.alias("v"), radices.alias("r"))
    start = F.transform(start, lambda x: F.struct(x["v"].alias("v"), x["r"].alias("r")))
    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, merge)
    return F.transform(done, lambda x: x["v"])


# -- symbols of a string: digits and letters move inside their own alphabet, all else stays ------------------------


def _alphabet(c: Column) -> Column:
    return (
        F.when(F.instr(F.lit(DIGITS), c) > 0, F.lit(DIGITS))
        .when(F.instr(F.lit(LOWERS), c) > 0, F.lit(LOWERS))
        .when(F.instr(F.lit(UPPERS), c) > 0, F.lit(UPPERS))
    )


def permute_symbols(text: Column, key: str, kind: str, hex_only: bool = False) -> Column:
    """Permutes the letters and digits of a string; ``hex_only``: hexadecimal digits, each kept in its case."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    if hex_only:
        upper = F.upper(text) == text
        alphabet = F.when(upper, F.lit("0123456789ABCDEF")).otherwise(F.lit("0123456789abcdef"))
        chars = F.filter(F.split(F.when(upper, text).otherwise(F.lower(text)), ""), lambda c: c != "")
        cells = F.transform(chars, lambda c: F.struct(c.alias("c"), F.when(F.instr(alphabet, c) > 0, alphabet).alias("a")))
    else:
        cells = F.transform(chars, lambda c: F.struct(c.alias("c"), _alphabet(c).alias("a")))
    moving = F.filter(cells, lambda x: x["a"].isNotNull())
    values = F.transform(moving, lambda x: (F.instr(x["a"], x["c"]) - 1).cast("long"))
    radices = F.transform(moving, lambda x: F.length(x["a"]).cast("long"))
    return _refill(cells, feistel(values, radices, key, kind))


def _refill(cells: Column, values: Column) -> Column:
    """Puts the values back in the moving places of ``cells`` (c, a), in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))
    return bind(
        values,
        lambda held: F.aggregate(
            cells,
            start,
            lambda s, x: F.struct(
                F.concat(
                    s["out"],
                    F.when(x["a"].isNull(), x["c"]).otherwise(F.substring(x["a"], F.get(held, s["k"]).cast("int") + 1, F.lit(1))),
                ).alias("out"),
                (s["k"] + F.when(x["a"].isNull(), 0).otherwise(1)).alias("k"),
            ),
        )["out"],
    )


def fill_digits(layout: Column, digits: Column) -> Column:
    """Writes a string of digits or capitals into the alphanumeric places of ``layout``, in order."""
    done = F.aggregate(
        F.filter(F.split(layout, ""), lambda c: c != ""),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("k")),
        lambda s, c: F.struct(
            F.concat(s["out"], F.when(c.rlike("[0-9A-Z]"), F.substring(digits, s["k"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (s["k"] + F.when(c.rlike("[0-9A-Z]"), 1).otherwise(0)).alias("k"),
        ),
    )
    return done["out"]


# -- checks ---------------------------------------------------------------------------------------------------------


def luhn_digit(body: Column) -> Column:
    """The check digit that follows the digits ``body``."""
    total = F.aggregate(
        F.transform(
            F.filter(F.split(F.reverse(body), ""), lambda c: c != ""),
            lambda c, i: F.when(
                i % 2 == 0, F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))
            ).otherwise(c.cast("int")),
        ),
        F.lit(0),
        lambda s, x: s + x,
    )
    return F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string")


def mod97(text: Column) -> Column:
    """Remainder by 97 of a row of digits and capitals, A standing for 10 and Z for 35."""
    return F.aggregate(
        F.filter(F.split(text, ""), lambda c: c != ""),
        F.lit(0).cast("long"),
        lambda s, c: F.when(c.rlike("[0-9]"), (s * 10 + c.cast("long")) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97),
    )


# -- one function per kind: the pseudonym, or null where the value fails its check ----------------------------------


def _email(m: Column, key: str) -> Column:
    return F.concat(permute_symbols(F.substring_index(m, "@", 1), key, "email"), F.lit("@"), F.substring_index(m, "@", -1))


def _ipv6(m: Column, key: str) -> Column:
    return permute_symbols(m, key, "ipv6", hex_only=True)


def _iban(m: Column, key: str) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country = F.substring(plain, 1, 2)

    def written(body: Column) -> Column:
        check = F.lpad((98 - mod97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
        return fill_digits(m, F.concat(country, check, body))

    valid = (F.length(plain).between(15, 34)) & (mod97(F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))) == 1)
    return F.when(valid, bind(permute_symbols(F.substr(plain, F.lit(5)), key, "iban"), written))


#: Days from 1900-01-01 to 2099-12-31: 17 * 4297, so two symbols hold exactly these dates.
DATE_RADICES = (17, 4297)


def _date(m: Column, key: str) -> Column:
    iso = F.when(m.contains("-"), m).when(
        m.contains("."), F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2))
    ).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2)))
    day = F.datediff(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date"), F.lit("1900-01-01").cast("date")).cast("long")
    a, b = DATE_RADICES
    out = feistel(
        F.array(F.floor(day / b).cast("long"), day % b), F.array(F.lit(a).cast("long"), F.lit(b).cast("long")), key, "date"
    )

    def written(v: Column) -> Column:
        new = F.date_add(F.lit("1900-01-01").cast("date"), (v[0] * b + v[1]).cast("int"))
        iso_or_dots = F.when(m.contains("-"), F.date_format(new, "yyyy-MM-dd")).when(m.contains("."), F.date_format(new, "dd.MM.yyyy"))
        return iso_or_dots.otherwise(F.date_format(new, "MM/dd/yyyy"))

    return F.when(day.isNotNull(), bind(out, written))


def _ipv4(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda c: c.cast("long"))
    out = feistel(octets, F.transform(octets, lambda _: F.lit(256).cast("long")), key, "ipv4")
    return F.when(F.forall(octets, lambda v: v < 256), F.array_join(F.transform(out, lambda v: v.cast("string")), "."))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.split_part(m, F.lit("-"), F.lit(i)).cast("long") for i in (1, 2, 3))
    values = F.array(area - 1 - F.when(area > 666, 1).otherwise(0), group - 1, serial - 1)
    out = feistel(values, F.array(*[F.lit(r).cast("long") for r in (898, 99, 9999)]), key, "ssn")
    valid = (area.between(1, 899)) & (area != 666) & (group > 0) & (serial > 0)

    def written(v: Column) -> Column:
        new_area = v[0] + 1 + F.when(v[0] + 1 >= 666, 1).otherwise(0)
        return F.concat_ws(
            "-",
            F.lpad(new_area.cast("string"), 3, "0"),
            F.lpad((v[1] + 1).cast("string"), 2, "0"),
            F.lpad((v[2] + 1).cast("string"), 4, "0"),
        )

    return F.when(valid, bind(out, written))


def _phone(m: Column, key: str) -> Column:
    head = F.regexp_extract(m, r"^\+[1-9][0-9]{0,2}(?=[ .(-])|^\+1(?=[0-9])|^\+", 0)
    rest = F.substr(m, F.length(head) + 1)
    n = F.length(F.regexp_replace(m, "[^0-9]", ""))
    return F.when(n.between(8, 15), F.concat(head, permute_symbols(rest, key, "phone")))


def _card(m: Column, key: str) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    body = F.substring(digits, F.lit(1), n - 1)
    written = bind(permute_symbols(body, key, "card"), lambda new: fill_digits(m, F.concat(new, luhn_digit(new))))
    return F.when(luhn_digit(body) == F.right(digits, F.lit(1)), written)


KINDS = {
    "email": _email,
    "ipv6": _ipv6,
    "iban": _iban,
    "date": _date,
    "ipv4": _ipv4,
    "ssn": _ssn,
    "phone": _phone,
    "card": _card,
}


def candidates(text: Column, kind: str) -> Column:
    """The different texts that have the pattern of ``kind``, wherever they start; cards end at every border of a group."""
    before, body, behind = PATTERNS[kind]
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(f"{before}(?=({body}){behind})"), F.lit(1)))
    if kind != "card":
        return found

    def ends(m: Column) -> Column:
        parts = F.array(*[F.regexp_extract(m, rf"^([0-9](?:[ -]?[0-9]){{{n - 1}}})(?![0-9])", 1) for n in range(19, 12, -1)])
        return F.filter(parts, lambda c: c != "")

    return F.array_distinct(F.flatten(F.transform(found, ends)))


def known(text: Column, key: str) -> Column:
    """array<struct<kind, m, value>> of the candidates that pass their check, by kind, long before short."""

    def tried(kind: str, check) -> Column:
        def one(m: Column) -> Column:
            return F.struct((-F.length(m)).alias("rank"), F.lit(kind).alias("kind"), m.alias("m"), check(m, key).alias("value"))

        return F.transform(candidates(text, kind), one)

    return F.concat(*[F.sort_array(F.filter(tried(kind, check), lambda x: x["value"].isNotNull())) for kind, check in KINDS.items()])


def places(values: Column) -> Column:
    """The regular expression of the given values where their kind may stand."""
    around = F.create_map(*[F.lit(x) for kind, (before, _, behind) in PATTERNS.items() for x in (f"{kind}<", before, f"{kind}>", behind)])
    ways = F.transform(
        values,
        lambda x: F.concat(
            F.element_at(around, F.concat(x["kind"], F.lit("<"))),
            F.lit("\\Q"),
            x["m"],
            F.lit("\\E"),
            F.element_at(around, F.concat(x["kind"], F.lit(">"))),
        ),
    )
    return F.concat(F.lit("((?<![0-9A-Za-z])(?:"), F.array_join(ways, "|"), F.lit("))"))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """The table with pseudonyms in its text column. ``found_col`` adds array<struct<kind, value>> of the pseudonyms."""
    text = F.col(text_col)
    none = F.array().cast("array<struct<rank:int,kind:string,m:string,value:string>>")
    out = docs.withColumn("_known", F.coalesce(F.when(text.rlike(HINT), known(text, key)), none))
    out = out.withColumn("_places", F.when(F.size("_known") > 0, places(F.col("_known"))))
    matches = F.regexp_extract_all(text, F.col("_places"), F.lit(1))
    out = out.withColumn("_matches", F.coalesce(F.when(F.size("_known") > 0, matches), F.array().cast("array<string>")))
    new = F.transform("_matches", lambda m: F.element_at(F.filter("_known", lambda x: x["m"] == m), 1))
    out = out.withColumn("_new", F.transform(new, lambda x: F.struct(x["kind"].alias("kind"), x["value"].alias("value"))))
    gaps = F.split(text, F.col("_places"), -1)
    woven = F.array_join(
        F.zip_with(gaps, "_new", lambda g, p: F.concat(g, F.coalesce(p["value"], F.lit("")))),
        "",
    )
    changed = F.when(F.size("_matches") > 0, woven).otherwise(text)
    out = out.withColumn(text_col, changed)
    if found_col:
        out = out.withColumn(found_col, F.col("_new"))
    return out.drop("_known", "_places", "_matches", "_new")
