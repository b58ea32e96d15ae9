"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score.

Base kinds are decided by pattern and checksum alone. Further spans of the
kinds card, phone and iban need a score of ``ACCEPT``: points for the form, for
the checksum, and for a context word shortly before the span. Built-in
functions only. Patterns are possessive and start only where a run starts (or
where the last match ended), so that long runs cost linear time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestal.llm.common import carried, kept_columns, restored, text_of

KINDS = ("email", "ip", "card", "phone", "iban")

# fixed values: the base forms
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# forms of the scored spans
NATIONAL_PHONE = r"(?:\([0-9]{3}\)\x20?|(?<![0-9+])[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"

#: Lengths of account numbers by country (fixed values of the public registry, and those in use beside it).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AO": 25, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BF": 28, "BG": 22, "BH": 22, "BI": 27, "BJ": 28,
    "BR": 29, "BY": 28, "CF": 27, "CG": 27, "CH": 21, "CI": 28, "CM": 27, "CR": 22, "CV": 25, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27,
    "DK": 18, "DO": 28, "DZ": 26, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GA": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GQ": 27, "GR": 27, "GT": 28, "GW": 25, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IR": 26,
    "IS": 26, "IT": 27, "JO": 30, "KM": 27, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25,
    "MA": 28, "MC": 27, "MD": 24, "ME": 22, "MG": 27, "MK": 19, "ML": 28, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "MZ": 25, "NE": 28,
    "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SN": 28, "SO": 23, "ST": 25, "SV": 28, "TD": 27, "TG": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}


def _account_form() -> str:
    """Exactly the length of the country, so that a match ends where the account ends, whatever words follow it."""
    by_length: dict[int, list[str]] = {}
    for country, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(country)
    forms = [rf"(?:{'|'.join(by_length[n])})(?:\x20?[0-9]){{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n in sorted(by_length)]
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(forms)})(?![A-Za-z0-9])"


IBAN = _account_form()

#: Words that make a span likelier, in the ``NEAR`` characters before it.
CONTEXT = {
    "card": "card|visa|mastercard|amex|credit|debit|karte|kreditkarte|carte|tarjeta",
    "phone": "phone|tel|call|fax|mobile|cell|telefon|handy|anruf|téléphone|teléfono|móvil",
    "iban": "iban|account|bank|konto|compte|cuenta",
}
NEAR, ACCEPT = 40, 70
#: Points for the form, for the checksum, which a span must pass where there is one, and for context.
POINTS = {"card": (30, 30, 30), "phone": (40, 0, 30), "iban": (30, 40, 30)}


#: Matches of a block; a start is the sum over whole blocks before it and over its own block's part.
BLOCK = 256


def with_spans(rows: DataFrame, kinds: dict[str, tuple[str, Column, Callable[[Column], Column]]]) -> DataFrame:
    """Adds for each name (pattern, worth, valid) the valid ones of the leftmost non-overlapping matches.

    A span is (start, end, match) in code points. The text between matches
    comes from splitting at them; ends are running sums over both, by blocks,
    so that a text of very many matches costs no more than its matches times
    ``BLOCK``. Where ``worth`` is false nothing is looked for.
    """
    text, none = F.col("_text"), F.array().cast("array<string>")
    rows = rows.withColumns({
        f"{step}_{name}": F.when(worth, value).otherwise(none)
        for name, (pattern, worth, _) in kinds.items()
        for step, value in (("_m", F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), ("_p", F.split(text, pattern, -1)))
    })
    numbered = lambda name: F.transform(f"_m_{name}", lambda m, i: F.struct(i.alias("i"), m.alias("match")))
    rows = rows.withColumns({f"_v_{name}": F.filter(numbered(name), valid) for name, (_, _, valid) in kinds.items()})
    length = lambda a, b: F.char_length(a).cast("long") + F.char_length(b)
    rows = rows.withColumns({
        f"_l_{name}": F.when(F.size(f"_v_{name}") > 0, F.zip_with(F.slice(f"_p_{name}", F.lit(1), F.size(f"_m_{name}")), f"_m_{name}", length))
        for name in kinds
    })
    add = lambda total, x: total + x
    zero = F.lit(0).cast("long")
    part = lambda name, block, size: F.aggregate(F.slice(f"_l_{name}", block * BLOCK + 1, size), zero, add)
    blocks = lambda name: F.sequence(F.lit(0), F.floor((F.size(f"_l_{name}") - 1) / BLOCK).cast("int"))
    whole = lambda name: F.transform(blocks(name), lambda block: part(name, block, F.lit(BLOCK)))
    grow = lambda before, x: F.concat(before, F.array(F.element_at(before, -1) + x))
    rows = rows.withColumns({f"_b_{name}": F.when(F.col(f"_l_{name}").isNotNull(), F.aggregate(whole(name), F.array(zero), grow)) for name in kinds})

    def span(name: str) -> Callable[[Column], Column]:
        def one(v: Column) -> Column:
            block = F.floor(v["i"] / BLOCK).cast("int")
            end = (F.get(f"_b_{name}", block) + part(name, block, v["i"] - block * BLOCK + 1)).cast("int")
            return F.struct((end - F.char_length(v["match"])).alias("start"), end.alias("end"), v["match"].alias("match"))

        return one

    return rows.withColumns({f"_{name}": F.transform(f"_v_{name}", span(name)) for name in kinds})


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit checks the others."""
    size = F.char_length(digits)

    def value(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when((size - i) % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number, letters as 10 to 35 and its first four characters last, leaves 1 modulo 97."""
    turned = F.concat(F.substring(account, F.lit(5), F.char_length(account)), F.substring(account, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _valid_ip(span: Column) -> Column:
    # by its digits: a part is of any length, and all zeros is a part too
    return F.forall(F.split(span["match"], r"\."), lambda part: part.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])$"))


def _valid_account(span: Column) -> Column:
    return mod97(F.regexp_replace(span["match"], " ", ""))


def _length(span: Column, least: int, most: int) -> Column:
    return F.char_length(digits_of(span["match"])).between(least, most)


def _near(text: Column, span: Column, kind: str) -> Column:
    """Points for a context word shortly before the span."""
    first = F.greatest(span["start"] - NEAR, F.lit(0))
    before = F.lower(F.substring(text, first + 1, span["start"] - first))
    return F.when(before.rlike(rf"(?<!\p{{L}})(?:{CONTEXT[kind]})(?!\p{{L}})"), POINTS[kind][2]).otherwise(0)


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


RESULT = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_scored")


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows with ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base spans), ``base_sha256``, ``spans`` and ``n_scored``.

    ``spans`` lists base and scored spans as kind:start:end by kind, then
    start; starts and ends are code points, ends exclusive. A scored span that
    overlaps a base one is left out. ``base_sha256`` is of the base spans alone.
    Input columns of these names, in any case of letters, are replaced. A null text counts as empty and
    has no spans. Repeated rows are judged one by one; an empty table gives an
    empty result.
    """
    body = F.col("_text")
    names = kept_columns(docs, RESULT)
    rows = docs.select(carried(names).alias("_row"), text_of(text).alias("_text"))
    number = F.col("_number")
    rows = rows.withColumn("_number", body.rlike("[0-9][^A-Za-z]*[0-9]"))
    digits = lambda least, most: lambda s: _length(s, least, most) & luhn(digits_of(s["match"]))
    rows = with_spans(rows, {
        "email": (EMAIL, F.contains(body, F.lit("@")), lambda _: F.lit(True)),
        "ip": (IP, number & F.contains(body, F.lit(".")), _valid_ip),
        "digits": (CARD, number, digits(13, 19)),
        "phone": (PHONE, number & F.contains(body, F.lit("+")), lambda s: _length(s, 8, 15)),
        "national": (NATIONAL_PHONE, number, lambda _: F.lit(True)),
        "account": (IBAN, number, _valid_account),
    })
    rows = rows.withColumn("_card", F.filter("_digits", lambda s: _length(s, 16, 19)))
    rows = rows.withColumn("_base", F.concat(*[_kind(F.col(f"_{k}"), k) for k in KINDS[:4]]))

    def scored(column: str, kind: str, valid: Callable[[Column], Column]) -> Column:
        points = POINTS[kind]

        def accepted(span: Column) -> Column:
            score = F.lit(points[0] + points[1]) + _near(body, span, kind)
            clear = ~F.exists("_base", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
            return (score >= ACCEPT) & clear

        return _kind(F.filter(F.filter(column, valid), accepted), kind)

    always = lambda _: F.lit(True)
    rows = rows.withColumn("_scored", F.concat(
        scored("_digits", "card", lambda s: _length(s, 13, 15)), scored("_national", "phone", always), scored("_account", "iban", always)
    ))
    count = lambda kind: F.size(f"_{kind}").cast("long")
    return rows.select(
        *restored(names),
        *[count(k).alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(_text(F.col("_base")), 256).alias("base_sha256"),
        _text(F.sort_array(F.concat("_base", "_scored"))).alias("spans"),
        F.size("_scored").cast("long").alias("n_scored"),
    )
