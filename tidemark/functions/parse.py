"""Column functions that read vendor text: numbers, periods, dates, tags and names. Nothing here raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names in order, for look-ups by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _part(c: Column, pattern: str, group: int) -> Column:
    """A group of the pattern as an integer; null where it does not match."""
    return F.regexp_extract(c, pattern, group).try_cast("int")


def _date(year: Column, month: Column | int, day: Column | int = 1) -> Column:
    """The date, or null if a part is null or there is no such day."""
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(F.lit(month).cast("string") if isinstance(month, int) else month.cast("string"), 2, "0"), F.lpad(F.lit(day).cast("string") if isinstance(day, int) else day.cast("string"), 2, "0"))
    parts = [year, *[p for p in (month, day) if isinstance(p, Column)]]
    whole = parts[0].isNotNull()
    for p in parts[1:]:
        whole = whole & p.isNotNull()
    return F.when(whole, F.try_to_date(text, "yyyy-MM-dd"))


def parse_stamp(c: Column) -> Column:
    """B1: a number or digit text as a UTC timestamp, told by its length.

    6 digits are YYYYMM, or the Monday of ISO week YYYYww where the last two exceed 12; 8 YYYYMMDD; 10 with the hour; 11
    with hour and tens of minutes; 12 with hour and minute. Anything else is null.
    """
    s = c.cast("string")
    n = F.length(s)
    year, two = F.substring(s, 1, 4).try_cast("int"), F.substring(s, 5, 2).try_cast("int")
    fourth = _date(year, 1, 4)
    monday = F.date_add(F.date_trunc("week", fourth).cast("date"), (two - 1) * 7)
    month_or_week = F.when(two.between(1, 12), _date(year, two)).when(two.between(13, 53), monday)
    minute = F.when(n == 11, F.concat(F.substring(s, 11, 1), F.lit("0"))).when(n == 12, F.substring(s, 11, 2)).otherwise(F.lit("00"))
    timed = F.try_to_timestamp(F.concat(F.substring(s, 1, 10), minute), F.lit("yyyyMMddHHmm"))
    return F.when(~s.rlike("^[0-9]+$"), None).when(n == 6, month_or_week.cast("timestamp")).when(n == 8, F.try_to_timestamp(s, F.lit("yyyyMMdd"))).when(n.between(10, 12), timed)


def period_to_date(c: Column, style: str = "sdmx", anchor: str = "start") -> Column:
    """B2: a period label as a date at the period's start, or with ``anchor="end"`` its last day. Bad labels are null.

    Styles: ``sdmx`` YYYY, YYYY-Qn, YYYY-MM; ``bea`` YYYY, YYYYQn, YYYYMnn; ``bls`` YYYY-Mnn and YYYY-Q0n, where M13 and Q05
    are annual figures inside a finer series and null; ``dotted`` YYYY.MM; ``packed`` YYYYMM or YYYYnn quarters (``YYYYQn``).
    """
    if style == "bls":
        year, month, quarter = _part(c, r"^(\d{4})-[MQ]\d\d$", 1), _part(c, r"^\d{4}-M(\d\d)$", 1), _part(c, r"^\d{4}-Q0?(\d)$", 1)
        year_only = F.lit(None).cast("int")
    elif style == "bea":
        year, month, quarter, year_only = _part(c, r"^(\d{4})[QM]\d+$", 1), _part(c, r"^\d{4}M(\d\d)$", 1), _part(c, r"^\d{4}Q(\d)$", 1), _part(c, r"^(\d{4})$", 1)
    elif style == "dotted":
        year, month, quarter, year_only = _part(c, r"^(\d{4})\.\d\d$", 1), _part(c, r"^\d{4}\.(\d\d)$", 1), F.lit(None).cast("int"), _part(c, r"^(\d{4})$", 1)
    elif style == "packed":
        year, month, quarter, year_only = _part(c, r"^(\d{4})(?:\d\d|Q\d)$", 1), _part(c, r"^\d{4}(\d\d)$", 1), _part(c, r"^\d{4}Q(\d)$", 1), _part(c, r"^(\d{4})$", 1)
    elif style == "sdmx":
        year, month, quarter, year_only = _part(c, r"^(\d{4})-(?:Q\d|\d\d)$", 1), _part(c, r"^\d{4}-(\d\d)$", 1), _part(c, r"^\d{4}-Q(\d)$", 1), _part(c, r"^(\d{4})$", 1)
    else:
        raise ValueError(f"unknown period style {style!r}")
    quarter = F.when(quarter.between(1, 4), quarter)
    monthly, quarterly, annual = _date(year, month), _date(year, quarter * 3 - 2), _date(year_only, 1)
    if anchor == "start":
        return F.coalesce(monthly, quarterly, annual)
    return F.coalesce(F.last_day(monthly), F.last_day(F.add_months(quarterly, 2)), F.last_day(F.add_months(annual, 11)))


def parse_number(c: Column, null_tokens: tuple[str, ...] = ("", "-", "--", "na", "n.a.", "n/a", "..", "...", "nan"), *, paren_negative: bool = False, decimal: str = ".") -> Column:
    """A number from text with thousands marks; null tokens and unreadable text are null.

    ``paren_negative`` reads "(1.5)" as -1.5; ``decimal=","`` is the locale with dots between thousands.
    """
    text = F.trim(c.cast("string"))
    text = F.translate(text, ".,", "\0.") if decimal == "," else text
    plain = F.regexp_replace(text, "[,\\s\\x00]", "")
    inner = F.regexp_extract(plain, r"^\((.*)\)$", 1)
    value = F.when(inner != "", -inner.try_cast("double")).otherwise(plain.try_cast("double")) if paren_negative else plain.try_cast("double")
    return F.when(F.lower(F.trim(c.cast("string"))).isin(*null_tokens), None).when(plain.rlike("(?i)nan|inf"), None).otherwise(value)


def first_number(c: Column) -> Column:
    """The first number in a display cell, thousands commas removed."""
    return F.regexp_extract(F.regexp_replace(c, ",", ""), r"-?(?:\d+\.?\d*|\.\d+)", 0).try_cast("double")


def split_revised(c: Column) -> tuple[Column, Column]:
    """(value without a trailing star, whether the star was there)."""
    return F.trim(F.regexp_replace(c, r"\*\s*$", "")), F.coalesce(c.rlike(r"\*\s*$"), F.lit(False))


def normalize_name(c: Column) -> Column:
    """Accents off the Latin letters, lower case, trimmed, single spaces."""
    accented = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
    plain = "aaaaaaceeeeiiiinooooouuuuyy"
    return F.regexp_replace(F.trim(F.translate(F.lower(c), accented, plain)), r"\s+", " ")


def slug(c: Column, width: int = 40) -> Column:
    """Upper case with runs of other characters as one underscore; beyond ``width`` a prefix and six hash digits."""
    body = F.regexp_replace(F.regexp_replace(F.upper(c), "[^A-Z0-9]+", "_"), "^_|_$", "")
    return F.when(F.length(body) <= width, body).otherwise(F.concat(F.substring(body, 1, width - 7), F.lit("_"), F.upper(F.substring(F.sha1(body), 1, 6))))


def encode_tenor(*legs: Column) -> Column:
    """The legs that are not null, lower-cased and joined: 2y, 10y -> "2y10y"; a single leg stays upper case."""
    count = sum((leg.isNotNull().cast("int") for leg in legs), F.lit(0))
    return F.when(count == 1, F.upper(F.coalesce(*legs))).when(count > 1, F.lower(F.concat_ws("s", *legs)))


def decode_tenor(c: Column) -> Column:
    """The legs of a tenor as an array, upper case."""
    return F.regexp_extract_all(F.upper(c), F.lit(r"(\d+[DWMY])"), F.lit(1))


def tenor_months(c: Column) -> Column:
    """Length of a single tenor in months (weeks and days as parts of one), for ordering."""
    n, unit = F.regexp_extract(F.upper(c), r"^(\d+)([DWMY])$", 1).try_cast("double"), F.regexp_extract(F.upper(c), r"^(\d+)([DWMY])$", 2)
    return F.when(unit == "D", n / 30).when(unit == "W", n / 4).when(unit == "M", n).when(unit == "Y", n * 12)


def normalize_tenor(c: Column) -> Column:
    """Aliases to one spelling: 12M is 1Y, 18M stays, 24M is 2Y."""
    months = F.regexp_extract(F.upper(F.trim(c)), r"^(\d+)M$", 1).try_cast("int")
    return F.when((months >= 12) & (months % 12 == 0), F.concat((months / 12).cast("int").cast("string"), F.lit("Y"))).otherwise(F.upper(F.trim(c)))


def tag_axes(c: Column, *names: str) -> list[Column]:
    """The dotted parts of a tag under the given names; a tag with another number of parts has nulls."""
    parts = F.split(c, r"\.")
    return [F.when(F.size(parts) == len(names), F.element_at(parts, k + 1)).alias(n) for k, n in enumerate(names)]


def orient_pair(ccy: Column, majors: tuple[str, ...] = ("EUR", "GBP", "AUD", "NZD")) -> tuple[Column, Column]:
    """(base, quote) of a currency against the dollar: four currencies are quoted first, all others second."""
    first = ccy.isin(*majors)
    return F.when(first, ccy).otherwise("USD"), F.when(first, F.lit("USD")).otherwise(ccy)


def candidates_for(a: Column, b: Column, priority: tuple[str, ...]) -> tuple[Column, Column]:
    """A pair's code in the order of a priority list, and the flipped code."""
    rank = lambda x: F.coalesce(F.array_position(F.array(*map(F.lit, priority)), x), F.lit(0))
    place = lambda x: F.when(rank(x) == 0, 10_000).otherwise(rank(x))
    keep = (place(a) < place(b)) | ((place(a) == place(b)) & (a <= b))
    return F.when(keep, F.concat(a, b)).otherwise(F.concat(b, a)), F.when(keep, F.concat(b, a)).otherwise(F.concat(a, b))


def mid_of(bid: Column, ask: Column, fallback: Column | None = None, *, zero_is_missing: bool = True) -> Column:
    """(bid + ask) / 2, else the side that is there, else ``fallback``."""
    b, a = (F.nullif(bid, F.lit(0)), F.nullif(ask, F.lit(0))) if zero_is_missing else (bid, ask)
    return F.coalesce((b + a) / 2, *([fallback] if fallback is not None else []), b, a)


def forward_points(outright: Column, spot: Column, divisor: Column | float) -> Column:
    """(outright - spot) * divisor, rounded to six places."""
    return F.round((outright - spot) * divisor, 6)


def outright(spot: Column, points: Column, divisor: Column | float = 1.0) -> Column:
    """Spot + points / divisor."""
    return spot + points / divisor


def spread_bps(bid: Column, ask: Column, mid: Column) -> Column:
    """The spread in basis points of mid; null for a missing or zero mid."""
    return (ask - bid) / F.nullif(mid, F.lit(0)) * 10000


def beat_miss(actual: Column, consensus: Column) -> Column:
    """B15: "beat", "miss" or "neutral" of two display cells; null where a number is missing."""
    a, c = first_number(actual), first_number(consensus)
    return F.when(a > c, "beat").when(a < c, "miss").when(a == c, "neutral")


def relevance(label: Column, tier: Column, ranks: dict[str, float]) -> Column:
    """A numeric label if there is one, 100 for the policy tier, else the tier's rank."""
    table = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    return F.coalesce(first_number(label), F.when(F.lower(tier) == "policy", F.lit(100.0)), table[tier].cast("double"))


def local_date(ts: Column, zone: Column | str) -> Column:
    """The date of a UTC instant in a zone, daylight saving included."""
    return F.from_utc_timestamp(ts, zone).cast("date")


def desk_time(date: Column, clock: Column, zone: str) -> Column:
    """A date and "HH:MM" or "HH:MM:SS" read in a fixed zone as a UTC instant; null for blank or bad times."""
    text = F.concat_ws(" ", date.cast("string"), F.trim(clock))
    read = F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")))
    return F.to_utc_timestamp(read, zone)


def parse_text_date(c: Column, formats: tuple[str, ...] = ("d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d-MMM-yyyy", "dd/MM/yyyy", "yyyy-MM-dd")) -> Column:
    """The first of several formats that reads the text, each tried in order."""
    return F.coalesce(*[F.try_to_date(F.trim(c), f) for f in formats])


def hour_starts(first: Column, last: Column) -> Column:
    """The start of every whole hour from the one that holds ``first`` to the last that has ended by ``last``."""
    hour = F.expr("interval 1 hour")
    a, b = F.date_trunc("hour", first), F.date_trunc("hour", last) - hour
    return F.when(a <= b, F.sequence(a, b, hour)).otherwise(F.array().cast("array<timestamp>"))


def month_key(c: Column) -> Column:
    """B19: "yyyy-MM"."""
    return F.date_format(c, "yyyy-MM")


def week_monday(c: Column) -> Column:
    """Monday of the date's ISO week."""
    return F.date_trunc("week", c).cast("date")


def prior_month(c: Column) -> Column:
    """First day of the month before."""
    return F.add_months(F.trunc(c, "MM"), -1)


def question_date(question: Column, default_year: Column | int) -> Column:
    """The date that a market question is about, by the first rule that applies.

    End of a quarter; end of a named month; by or before a year's end; a month and a day; a month's meeting (the
    15th); a bare month (its last day); in a year (its last day).
    """
    q = F.lower(question)
    default = F.lit(default_year) if isinstance(default_year, int) else default_year
    year = F.coalesce(_part(q, r"\b(20\d\d)\b", 1), default)
    names = "|".join(MONTHS)
    word = F.regexp_extract(q, rf"\b({names})[a-z]*\b", 1)
    month = F.when(word != "", F.array_position(F.array(*map(F.lit, MONTHS)), word).cast("int"))
    day = _part(q, rf"\b(?:{names})[a-z]*\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?\b", 1)
    quarter = _part(q, r"\bq([1-4])\b", 1)
    year_end = _date(year, 12, 31)
    return F.coalesce(
        F.when(quarter.isNotNull(), F.last_day(_date(year, quarter * 3))),
        F.when(q.rlike(rf"end of (?:{names})"), F.last_day(_date(year, month))),
        F.when(q.rlike(r"(?:end of|by|before)(?: the end of)?(?: year)?\s*20\d\d"), year_end),
        F.when(day.between(1, 31), _date(year, month, day)),
        F.when(q.contains("meeting"), _date(year, month, 15)),
        F.last_day(_date(year, month)),
        F.when(q.rlike(r"\bin 20\d\d"), year_end),
    )


def yes_no_prices(c: Column) -> tuple[Column, Column]:
    """The first two prices of a JSON list of number texts."""
    prices = F.from_json(c, "array<string>")
    return F.get(prices, F.lit(0)).try_cast("double"), F.get(prices, F.lit(1)).try_cast("double")


def is_illiquid(spread: Column, price: Column, cap: float = 0.30, relative_cap: float = 0.50) -> Column:
    """The spread is above an absolute cap, or above a share of the nearer side of the price (0.05 at least)."""
    return (spread > cap) | (spread / F.greatest(F.least(price, 1 - price), F.lit(0.05)) > relative_cap)


def first_rule(c: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first (substring, label) whose substring the lower-cased text holds."""
    low = F.lower(c)
    return F.coalesce(*[F.when(low.contains(s), F.lit(label)) for s, label in rules], F.lit(default))


def single_match(title: Column, patterns: dict[str, str], veto: str | None = None) -> Column:
    """The name whose pattern the title matches, if exactly one does and the veto pattern does not."""
    hits = F.filter(F.array(*[F.when(title.rlike(p), F.lit(name)) for name, p in patterns.items()]), lambda x: x.isNotNull())
    allowed = ~title.rlike(veto) if veto else F.lit(True)
    return F.when(allowed & (F.size(hits) == 1), F.get(hits, F.lit(0)))


def noise_reason(title: Column, substrings: tuple[str, ...], prefixes: tuple[str, ...], patterns: tuple[str, ...]) -> Column:
    """Why a title is noise - substring before prefix before pattern before date-only - or null."""
    low = F.lower(F.trim(title))
    reasons = [F.when(low.contains(s), F.lit(f"substring:{s}")) for s in substrings] + [F.when(low.startswith(p), F.lit(f"prefix:{p}")) for p in prefixes]
    reasons += [F.when(low.rlike(p), F.lit(f"pattern:{p}")) for p in patterns] + [F.when(low.rlike(r"^[\d\s/.,-]+$"), F.lit("date-only"))]
    return F.coalesce(*reasons)


def content_hash(*parts: Column) -> Column:
    """SHA-256 over the parts, a line each."""
    return F.sha2(F.concat_ws("\n", *parts), 256)


def authors(c: Column) -> Column:
    """Names split at commas, semicolons and "and", trimmed, blanks and repeats removed."""
    names = F.transform(F.split(c, r"\s*(?:[,;]|\band\b)\s*"), lambda x: F.trim(x))
    return F.array_distinct(F.filter(names, lambda x: x != ""))


def aliased(c: Column, aliases: dict[str, str]) -> Column:
    """The alias of a code, or the code."""
    return F.coalesce(F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])[c], c)


def imm_date(year: Column, month: Column) -> Column:
    """Third Wednesday of a month."""
    return F.date_add(F.next_day(F.date_sub(F.make_date(year, month, F.lit(1)), 1), "WED"), 14)


def is_imm_date(c: Column, *, quarterly: bool = True) -> Column:
    """Whether a date is a third Wednesday, of a quarter's last month only unless told otherwise."""
    third = (F.weekday(c) == 2) & F.dayofmonth(c).between(15, 21)
    return third & (F.month(c) % 3 == 0) if quarterly else third


def next_imm_date(c: Column) -> Column:
    """The first quarterly third Wednesday after a date."""
    at = lambda k: imm_date(F.year(F.add_months(F.trunc(c, "quarter"), k)), F.month(F.add_months(F.trunc(c, "quarter"), k)))
    return F.when(at(2) > c, at(2)).otherwise(at(5))


def is_fx_open(ts: Column) -> Column:
    """The FX market is open from Sunday 21:00 to Friday 21:00 UTC."""
    day, hour = F.weekday(ts), F.hour(ts)
    return F.when(day == 6, hour >= 21).when(day == 4, hour < 21).when(day == 5, False).otherwise(ts.isNotNull() & F.lit(True))


def pass_hour(ts: Column, hours: tuple[int, ...]) -> Column:
    """The last scheduled hour not after the instant; before the first one, the last of the day before."""
    past = F.filter(F.array(*map(F.lit, sorted(hours))), lambda h: h <= F.hour(ts))
    return F.when(F.size(past) > 0, F.array_max(past)).otherwise(max(hours))


def in_window(hour: Column, low: int, high: int) -> Column:
    """The hour is in a window that may wrap around midnight (low included, high not)."""
    return (hour >= low) & (hour < high) if low < high else (hour >= low) | (hour < high)


def age_label(ts: Column, now: Column, stale_days: int = 7, dead_days: int = 60) -> Column:
    """C21: "live", "stale" or "dead" by the age of the last point; "dead" without one."""
    age = F.datediff(now, ts)
    return F.when(age <= stale_days, "live").when(age <= dead_days, "stale").otherwise("dead")
