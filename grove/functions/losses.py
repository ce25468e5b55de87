"""Losses and their derivatives as SQL expressions over a score and a label.

``g`` is the negative first derivative and ``h`` the second derivative, both before the row weight.
Two families exist: the leaf-wise engine's and the binned engine's.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The losses of each engine and the bound on exponents.
LEAFWISE_TRAINABLE = ("LS", "Expo", "Log", "Logit", "LogRe", "LogRe2", "Abs")
LEAFWISE_VALUE_ONLY = ("ModLS", "ModHuber")
EXPO_FAMILY = ("Expo", "Log", "Logit", "LogRe", "LogRe2")
BINNED_TRAINABLE = ("LS", "MODLS", "LOGISTIC")
EXPONENT_BOUND = "500D"

CLASSIFICATION = ("Expo", "Log", "Logit", "ModLS", "ModHuber", "MODLS", "LOGISTIC")


def check_loss(loss: str, engine: str, trainable: bool = True) -> None:
    names = BINNED_TRAINABLE if engine == "binned" else LEAFWISE_TRAINABLE
    if engine != "binned" and not trainable:
        names = names + LEAFWISE_VALUE_ONLY
    if loss not in names:
        raise ValueError(f"loss {loss!r} is not one of {names}")


def _exp(x: str) -> str:
    return f"exp(greatest(-{EXPONENT_BOUND}, least({EXPONENT_BOUND}, {x})))"


def loss_sql(loss: str, s: str, y: str, engine: str = "leafwise", shift: float = 0.0) -> str:
    check_loss(loss, engine, trainable=False)
    margin, residual = f"({s} * {y})", f"({y} - {s})"
    half_square = f"{residual} * {residual} / 2"
    if engine == "binned":
        return {
            "LS": f"{residual} * {residual}",
            "MODLS": f"CASE WHEN {margin} < 1 THEN ({margin} - 1) * ({margin} - 1) ELSE 0D END",
            "LOGISTIC": f"log1p(exp(-{margin}))",
        }[loss]
    return {
        "LS": half_square,
        "Expo": _exp(f"-({margin} - {float(shift)!r}D)"),
        "Log": f"log1p({_exp(f'-{margin}')})",
        "Logit": f"log1p({_exp(f'-2 * {margin}')})",
        "LogRe": f"(log1p({_exp(f'-({s})')}) + (1 - {y}) * greatest(-{EXPONENT_BOUND}, {s}))",
        "LogRe2": f"(2 * log1p({_exp(f'-{residual}')}) + {residual} - 2 * ln(2D))",
        "ModLS": f"CASE WHEN {margin} <= 1 THEN {half_square} ELSE 0D END",
        "ModHuber": f"CASE WHEN {margin} <= -1 THEN -2 * {margin} WHEN {margin} < 1 THEN {half_square} ELSE 0D END",
        "Abs": f"abs({residual})",
    }[loss]


def derivative_sql(loss: str, s: str, y: str, engine: str = "leafwise", shift: float = 0.0) -> tuple[str, str]:
    """``(g, h)``; ``shift`` is the mean margin that keeps ``Expo`` in range."""
    check_loss(loss, engine)
    margin, residual = f"({s} * {y})", f"({y} - {s})"
    if loss == "LS":
        return residual, "1D"
    if loss == "MODLS":
        return (
            f"CASE WHEN {margin} > 1 THEN 0D ELSE {residual} END",
            f"CASE WHEN {margin} > 1 THEN greatest(0.1D, 1 - 5 * ({margin} - 1)) ELSE 1D END",
        )
    if loss == "LOGISTIC":
        p = f"(1 / (1 + exp(-({s}))))"
        return f"CASE WHEN {y} > 0 THEN 1D ELSE 0D END - {p}", f"{p} * (1 - {p})"
    if loss == "Abs":
        return f"CASE WHEN {y} > {s} THEN 1D ELSE -1D END", "0D"
    if loss == "Expo":
        e = _exp(f"-({margin} - {float(shift)!r}D)")
        return f"{y} * {e}", f"{y} * {y} * {e}"
    if loss in ("Log", "Logit"):
        k = 1 if loss == "Log" else 2
        e = _exp(f"-{k} * {margin}")
        return f"{k} * {y} * {e} / (1 + {e})", f"{k * k} * {y} * {y} * {e} / (1 + {e}) / (1 + {e})"
    if loss == "LogRe":
        q = f"(1 / (1 + {_exp(f'-({s})')}))"
        return f"({y} - {q})", f"{q} * (1 - {q})"
    q = f"(1 / (1 + {_exp(residual)}))"
    return f"(1 - 2 * {q})", f"2 * {q} * (1 - {q})"


def loss_value(loss: str, score: str, label: str, engine: str = "leafwise", shift: float = 0.0) -> Column:
    return F.expr(loss_sql(loss, score, label, engine, shift))


def derivatives(loss: str, score: str, label: str, engine: str = "leafwise", shift: float = 0.0) -> tuple[Column, Column]:
    g, h = derivative_sql(loss, score, label, engine, shift)
    return F.expr(g), F.expr(h)
