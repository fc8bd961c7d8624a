"""The literal predicates against Python itself on generated strings:
missing = not s.strip(), int(s), float(s), datetime.strptime(s, fmt)."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from tessera.functions.predicates import DATE_FORMATS, is_date_format
from tessera.operators.profile import cell_flags

ALPHABET = list("0123456789") * 4 + list("+-._eEnaifty /: \t") + ["\xa0", "x", "d", "N", "I"]


def python_flags(s: str):
    def ok(fn):
        try:
            fn(s)
            return True
        except (ValueError, OverflowError):
            return False
    missing = not s.strip()
    return (missing, (not missing) and ok(int), (not missing) and ok(float),
            *[ok(lambda v, f=f: datetime.strptime(v, f)) for f, _, _ in DATE_FORMATS])


def samples(n: int = 3000):
    rnd = random.Random(20251130)
    out = ["", " ", "\t", "\xa0", "0", "-0", "+5", "1_000", "1__0", "_1", "1_", "1.", ".5", "1e5", "1E+5", "1e",
           "nan", "-NaN", "inf", "+Infinity", "infinity", "1d", "1f", "0x10", "007", " 12 ", "\xa05\xa0",
           "2022-1-5", "2022-01- 5", "2022- 1-05", "22-01-05", "2022-02-29", "2024-02-29", "0000-01-01",
           "0001-01-01", "9999-12-31", "01/13/2022", "13/01/2022", " 5/01/2022", "2022/01/05", "2022-13-01"]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 10))))
    for _ in range(n // 2):
        y, m, d = rnd.randint(0, 2100), rnd.randint(0, 13), rnd.randint(0, 32)
        sep = rnd.choice("-/")
        parts = [rnd.choice([f"{y:04d}", str(y)]), rnd.choice([f"{m:02d}", str(m)]),
                 rnd.choice([f"{d:02d}", str(d), f" {d}" if d < 10 else str(d)])]
        rnd.shuffle(parts)
        out.append(sep.join(parts))
    return out


def test_predicates_agree_with_python(spark):
    vals = samples()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "row_no long, value string")
    cells = df.select(F.lit("f").alias("file_name"), "row_no", F.lit(1).alias("ordinal"),
                      F.lit("c").alias("column"), "value")
    flags = cell_flags(cells).select("row_no", "is_missing", "is_int", "is_float",
                                     *[is_date_format("value", i).alias(f"d{i}") for i in range(4)])
    got = {r["row_no"]: tuple(r)[1:] for r in flags.collect()}
    bad = [(vals[i], got[i], python_flags(vals[i])) for i in range(len(vals)) if got[i] != python_flags(vals[i])]
    assert not bad, bad[:10]
