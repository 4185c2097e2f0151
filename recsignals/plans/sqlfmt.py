"""Small text helpers for writing oracle SQL with the same output hygiene as
:func:`recsignals.functions.expr.finalize`."""


def rnd(*cols: str, src: str = "") -> str:
    p = f"{src}." if src else ""
    return ", ".join(f"ROUND(CAST({p}{c} AS DOUBLE), 6) AS {c}" for c in cols)


def big(*cols: str, src: str = "") -> str:
    p = f"{src}." if src else ""
    return ", ".join(f"CAST({p}{c} AS BIGINT) AS {c}" for c in cols)


def sum_window(cols, frame: str, window: str, tmpl: str = "rolling_{c}_{f}") -> str:
    return ", ".join(f"SUM({c}) OVER {window} AS {tmpl.format(c=c, f=frame)}" for c in cols)


def hours(n: int) -> str:
    return f"RANGE BETWEEN INTERVAL '{n}' HOUR PRECEDING AND INTERVAL '1' MICROSECOND PRECEDING"


def days(n: int) -> str:
    return f"RANGE BETWEEN INTERVAL '{n}' DAY PRECEDING AND INTERVAL '1' MICROSECOND PRECEDING"
