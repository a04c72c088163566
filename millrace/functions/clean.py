"""Cleaning and validation of text, dates and records.

Cleaners are Column to Column. Validators return an ``array<string>`` of error messages
that is empty for a good row, so bad rows can be split off instead of stopping the job.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns and lists of the validation rules.
EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
CURRENCIES = ("USD", "EUR", "IDR", "SGD")
WEBHOOK_TYPES = ("user_created", "user_updated", "user_deleted")
RELEVANT_METALS = ("gold", "silver", "platinum", "copper", "nickel")
NUMBER_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def errors(*rules: tuple[Column, str | Column]) -> Column:
    """Messages of the rules whose condition holds; an unknown (NULL) condition does not fire."""
    return F.array_compact(F.array(*[
        F.when(bad, F.lit(msg) if isinstance(msg, str) else msg) for bad, msg in rules
    ]).cast("array<string>"))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def to_number(text: Column) -> Column:
    """Double for number-shaped text, else NULL. The text is evaluated once."""
    return F.regexp_extract(text, NUMBER_SHAPE, 0).try_cast("double")


def clean_email(email: Column) -> Column:
    return F.coalesce(F.lower(strip(email)), F.lit(""))


def email_errors(email: Column) -> Column:
    given = F.coalesce(email, F.lit("")) != ""
    return errors((given & ~F.contains(email, F.lit("@")), F.concat(F.lit("Invalid email format: "), email)))


def _without_currency(text: Column) -> Column:
    for mark in ("$", "Rp", " "):
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def parse_amounts(df: DataFrame, text: str, out: str) -> DataFrame:
    """Amount from US (1,234.56), European (1.234,56) or Indonesian (1.234.567) text.

    Empty is 0; text that is no number is NULL. The text without its currency marks is a column
    of its own, so that the branches below share it instead of computing it again.
    """
    bare = F.col("_bare")
    comma, dot = F.instr(bare, ","), F.instr(bare, ".")
    no_commas, no_dots = F.replace(bare, F.lit(","), F.lit("")), F.replace(bare, F.lit("."), F.lit(""))
    decimals_after = {c: F.length(F.substring_index(bare, c, -1)) for c in ",."}
    several_dots = F.length(bare) - F.length(no_dots) > 1
    plain = (
        F.when((comma > 0) & (dot > 0), F.when(comma < dot, no_commas).otherwise(F.replace(no_dots, F.lit(","), F.lit("."))))
        .when(comma > 0, F.when(decimals_after[","] == 2, F.replace(bare, F.lit(","), F.lit("."))).otherwise(no_commas))
        .when((dot > 0) & (several_dots | (decimals_after["."] == 3)), no_dots)
        .otherwise(bare)
    )
    empty = F.coalesce(F.col(text), F.lit("")) == ""
    return (df.withColumn("_bare", _without_currency(F.col(text)))
            .withColumn(out, F.when(empty, F.lit(0.0)).otherwise(to_number(plain))).drop("_bare"))


def parse_amount_lenient(text: Column) -> Column:
    """Amount with symbols and commas removed; anything else is 0."""
    return F.coalesce(to_number(F.replace(_without_currency(text), F.lit(","), F.lit(""))), F.lit(0.0))


def parse_instant(text: Column) -> Column:
    """ISO text (``Z`` allowed) or epoch milliseconds to a UTC timestamp, else NULL."""
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))
    millis = F.timestamp_millis(F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint")))
    return F.coalesce(iso, millis)


def format_instant(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(parse_instant(text), fmt)


def normalize_symbol(symbol: Column) -> Column:
    return F.when(F.coalesce(symbol, F.lit("")) == "", "UNKNOWN").otherwise(
        F.regexp_replace(strip(F.upper(symbol)), "[^A-Z]", "-"))


def clean_phone(phone: Column) -> Column:
    return F.coalesce(F.regexp_replace(phone, "[^0-9+]", ""), F.lit(""))


def phone_ok(phone: Column) -> Column:
    return F.length(F.regexp_replace(phone, "[^0-9]", "")) >= 10


def email_ok(email: Column) -> Column:
    return F.coalesce(email.rlike(EMAIL_PATTERN), F.lit(False))


def email_structure_ok(email: Column) -> Column:
    """One ``@``, something on both sides, a dot in the domain."""
    parts = F.split(email, "@", -1)
    ok = (F.size(parts) == 2) & (F.get(parts, F.lit(0)) != "") & F.get(parts, F.lit(1)).contains(".")
    return F.coalesce(ok, F.lit(False))


def _missing(names: Sequence[str]) -> Column:
    return errors(*[(F.col(n).isNull(), f"Missing required field: {n}") for n in names])


def required_then(names: Sequence[str], rules: Column) -> Column:
    """Missing-field messages if there are any, else the other rules."""
    missing = _missing(names)
    return F.when(F.size(missing) > 0, missing).otherwise(rules)


def user_errors() -> Column:
    """Rules for columns user_id, name, email, age and optional phone."""
    return required_then(["user_id", "name", "email", "age"], errors(
        (F.col("user_id") <= 0, "user_id must be a positive integer"),
        (F.col("name") == "", "name must be a non-empty string"),
        (F.col("email") == "", "Email cannot be empty"),
        ((F.col("email") != "") & ~email_ok(F.col("email")), F.concat(F.lit("Invalid email format: "), "email")),
        (F.col("age") < 0, "Age cannot be negative"),
        (F.col("age") > 150, "Age cannot exceed 150"),
        (F.col("phone") == "", "Phone number cannot be empty"),
        ((F.col("phone") != "") & ~phone_ok(F.col("phone")), F.concat(
            F.lit("Phone number must have at least 10 digits, got "),
            F.length(F.regexp_replace("phone", "[^0-9]", "")).cast("string"))),
    ))


def signup_errors() -> Column:
    """Rules for columns email, username and age of a new account."""
    no_email, no_name = F.coalesce("email", F.lit("")) == "", F.coalesce("username", F.lit("")) == ""
    return errors(
        (no_email, "Email is required"),
        (~no_email & ~F.col("email").contains("@"), "Email format invalid"),
        (no_name, "Username is required"),
        (~no_name & ~F.replace("username", F.lit("_"), F.lit("")).rlike(r"^[\p{L}\p{N}]+$"), "Username must be alphanumeric"),
        (F.col("age").isNull(), "Age is required"),
        (F.col("age") < 18, "User must be at least 18 years old"),
    )


def transaction_errors(as_of: datetime) -> Column:
    """Rules for text columns transaction_id, currency, timestamp and a numeric amount."""
    at = F.unix_micros(parse_instant(F.col("timestamp")))
    now = F.unix_micros(F.lit(as_of).cast("timestamp_ntz").cast("timestamp"))
    return required_then(["transaction_id", "amount", "currency", "timestamp"], errors(
        (F.col("amount") <= 0, "amount must be positive"),
        (~F.col("currency").isin(*CURRENCIES), "currency must be one of USD, EUR, IDR, SGD"),
        (at.isNull(), "timestamp must be valid ISO format"),
        (at > now, "timestamp cannot be in the future"),
        (now - at > 24 * 3600 * 1_000_000, "timestamp must be within last 24 hours"),
    ))


def card_digits(number: Column) -> Column:
    return F.regexp_replace(number, "[^0-9]", "")


def card_errors(as_of: datetime) -> Column:
    """Rules for columns card_number, cvv, expiry_month, expiry_year."""
    digits = card_digits(F.col("card_number"))
    length_ok = F.length(digits).between(13, 19)
    year, month = F.col("expiry_year"), F.col("expiry_month")
    expired = (year < as_of.year) | ((year == as_of.year) & (month < as_of.month))
    return errors(
        (~length_ok, "Card number must be 13-19 digits"),
        (length_ok & ~F.call_function("luhn_check", digits), "Invalid card number (failed Luhn check)"),
        (~F.col("cvv").rlike(r"^\d{3,4}$"), "CVV must be 3 or 4 digits"),
        (~month.between(1, 12), "expiry_month must be 1-12"),
        (expired, "Card has expired"),
    )


def password_errors(password: Column, confirmation: Column) -> Column:
    return errors(
        (F.length(password) < 8, "password shorter than 8 characters"),
        (~password.rlike(r"\p{Lu}"), "password needs an uppercase letter"),
        (~password.rlike(r"\p{Nd}"), "password needs a digit"),
        (~password.eqNullSafe(confirmation), "passwords do not match"),
    )


def clean_name(name: Column) -> Column:
    """Whitespace collapsed, each word capitalised; NULL when shorter than two characters."""
    flat = F.regexp_replace(strip(name), r"\s+", " ")
    return F.when(F.length(flat) >= 2, F.initcap(flat))


def tick_errors(as_of: datetime, min_symbol: int = 3) -> Column:
    """Rules for columns symbol, price, volume and timestamp."""
    now = F.lit(as_of).cast("timestamp_ntz")
    return errors(
        (~F.length("symbol").between(min_symbol, 10), f"symbol must have {min_symbol}-10 characters"),
        (F.col("symbol").isNull(), "symbol is required"),
        (F.coalesce(F.col("price") <= 0, F.lit(True)), "price must be positive"),
        (F.col("volume") < 0, "volume must not be negative"),
        (F.col("timestamp").cast("timestamp_ntz") > now, "timestamp is in the future"),
    )


def parse_trades(df: DataFrame, raw: str) -> DataFrame:
    """Raw trade JSON ``{s, p, T}`` to symbol, price and event time (seconds, rounded down)."""
    trade = F.from_json(raw, "s string, p string, T bigint")
    seconds = F.floor(F.col("_t.T") / 1000).cast("bigint")
    others = [c for c in df.columns if c != raw]
    return df.withColumn("_t", trade).select(
        *others, F.col("_t.s").alias("symbol"), to_number(F.col("_t.p")).alias("price"),
        seconds.alias("event_time"), F.timestamp_seconds(seconds).alias("event_ts"))


def to_local_time(ts: Column, zone: str = "Asia/Jakarta") -> Column:
    return F.from_utc_timestamp(ts, zone)


def metal_payload_errors(payload: Column) -> Column:
    """Rules for a struct timestamp, status, metals map<string,double>, currency_base."""
    metals = payload["metals"]
    return errors(
        *[(payload[f].isNull(), f"{f}: field required") for f in ("timestamp", "status", "metals", "currency_base")],
        (F.cardinality(metals) == 0, "metals dictionary must not be empty"),
        (F.exists(F.map_values(metals), lambda v: v.isNull()), "metals: value is not a valid number"),
        (F.exists(F.map_values(metals), lambda v: v <= 0), "metals: value must be greater than 0"),
    )


def relevant_metals(metals: Column) -> Column:
    return F.map_filter(metals, lambda k, v: k.isin(*RELEVANT_METALS))


def rates_errors(payload: Column, needed: Sequence[str] = ("IDR",)) -> Column:
    """Rules for a struct date, base, rates map<string,double>."""
    rates = payload["rates"]
    return errors(
        *[(payload[f].isNull(), f"{f}: field required") for f in ("date", "base", "rates")],
        (F.cardinality(rates) == 0, "rates dictionary must not be empty"),
        (F.exists(F.map_values(rates), lambda v: v.isNull() | (v <= 0)), "rates: value must be greater than 0"),
        *[(~F.map_contains_key(rates, F.lit(c)), f"rates: {c} is missing") for c in needed],
    )


def macro_errors(payload: Column) -> Column:
    """Rules for a struct count, offset, limit, observations array<struct<date,value>>."""
    obs = payload["observations"]
    return errors(
        *[(F.coalesce(payload[f] < 0, F.lit(True)), f"{f} must be 0 or more") for f in ("count", "offset", "limit")],
        (F.coalesce(F.size(obs) < 1, F.lit(True)), "observations list must not be empty"),
        (F.exists(obs, lambda o: o["date"].isNull() | o["value"].isNull()), "each observation must contain date and value keys"),
    )


def news_errors(payload: Column) -> Column:
    """Rules for a struct status, totalResults."""
    return errors(
        (~payload["status"].eqNullSafe(F.lit("ok")), 'status must be "ok"'),
        (F.coalesce(payload["totalResults"] < 0, F.lit(True)), "totalResults must be 0 or more"),
    )


def envelope_errors() -> Column:
    """Rules for columns status, data and error of an API answer."""
    ok, failed = F.col("status") == "success", F.col("status") == "error"
    return errors(
        (F.coalesce(~(ok | failed), F.lit(True)), "status must be success or error"),
        (ok & (F.coalesce("data", F.lit("")) == ""), "a success response must have data"),
        (failed & (F.coalesce("error", F.lit("")) == ""), "an error response must have a message"),
    )


def has_more(page: Column, per_page: Column, total: Column) -> Column:
    return page * per_page < total


def normalize_webhooks(df: DataFrame) -> DataFrame:
    """Loose webhook rows (event_type, data map, timestamp text) to typed rows plus errors."""
    user = F.try_element_at("data", F.lit("user_id")).try_cast("bigint")
    typed = df.withColumns({"user_id": user, "event_ts": parse_instant(F.col("timestamp"))})
    return typed.withColumn("errors", errors(
        (F.coalesce(~F.col("event_type").isin(*WEBHOOK_TYPES), F.lit(True)), "unknown event_type"),
        (F.coalesce(F.col("user_id") <= 0, F.lit(True)), "user_id must be a positive integer"),
        (F.col("event_ts").isNull(), "invalid timestamp"),
    ))


def standardise_orders(df: DataFrame, inserted_at: datetime | None = None) -> DataFrame:
    """Raw order text (order_id, customer_id, order_date, status, total) to the silver layout."""
    at = F.current_timestamp() if inserted_at is None else F.lit(inserted_at).cast("timestamp_ntz")
    return df.select(
        "order_id",
        F.trim("customer_id").alias("customer_id"),
        F.try_to_timestamp(F.trim("order_date"), F.lit("MM/dd/yyyy")).cast("date").alias("order_date"),
        F.upper(F.trim("status")).alias("status"),
        to_number(F.trim("total")).alias("total"),
        at.alias("inserted_at"),
    )


def parse_json_strict(df: DataFrame, raw: str, schema: str, out: str = "parsed") -> DataFrame:
    """Parse JSON; invalid or empty text becomes an error row instead of a silent NULL."""
    bad = F.try_parse_json(raw).isNull()
    return df.withColumns({
        out: F.when(~bad, F.from_json(F.when(~bad, F.col(raw)), schema)),
        "error": F.when(F.coalesce(F.trim(raw), F.lit("")) == "", "empty JSON").when(bad, "invalid JSON"),
    })


def clean_text(text: Column) -> Column:
    return F.regexp_replace(F.lower(strip(text)), r"\s+", " ")


def delay_seconds(broker: Column, event: Column) -> Column:
    return F.unix_timestamp(broker) - F.unix_timestamp(event)


WEATHER_JSON = (
    "current struct<time:string, temperature_2m:double, precipitation:double, wind_speed_10m:double, "
    "relative_humidity_2m:double, apparent_temperature:double, weather_code:int>"
)


def extract_weather(df: DataFrame, raw: str, truncate: bool = False) -> DataFrame:
    """Weather JSON to one typed row; ``truncate`` drops the fraction of the precipitation."""
    from millrace.operators.columns import weather_label

    others = [c for c in df.columns if c != raw]
    now = df.select(*others, F.from_json(raw, WEATHER_JSON)["current"].alias("_c"))
    rain = F.col("_c.precipitation")
    return now.select(
        *others, "_c.time", "_c.temperature_2m", (rain.cast("int") if truncate else rain).alias("precipitation"),
        "_c.wind_speed_10m", "_c.relative_humidity_2m", "_c.apparent_temperature",
        weather_label(F.col("_c.weather_code")).alias("weather"))
