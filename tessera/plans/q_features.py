"""Registered feature-engineering queries (T09-T13, T15) with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.exprs import r6
from tessera.operators import clean as C
from tessera.operators import features as FE
from tessera.plans.registry import register
from tessera.roles import Roles
from tessera.sources.bank import bank_materialized, bank_view, sql_with

CAT = ["job", "marital", "education", "contact"]
ALL = ["id", "age", "job", "marital", "education", "contact", "balance", "duration", "campaign",
       "previous", "y", "split"]
RARE_T = 0.05
Q = 10
CAP_Q = 0.99
ROLES = Roles()


def _dbl(c):
    return f"CAST({c} AS DOUBLE)"


def _rare_sql(src: str, cols: dict[str, str], thr: float) -> tuple[str, dict]:
    """CTEs with rare values per column and replacement expressions.
    ``cols`` maps column -> 'text' | 'int' | 'double'."""
    ctes, exprs = [], {}
    for c, kind in cols.items():
        ctes.append(
            f"r_{c} AS (SELECT CAST({c} AS VARCHAR) AS v FROM {src} WHERE {c} IS NOT NULL GROUP BY 1 "
            f"HAVING count(*) / (SELECT count(*) FROM {src}) <= {thr} "
            f"AND (SELECT count(DISTINCT {c}) FROM {src}) <= {FE.RARE_MAX_UNIQUE})")
        code = "'-1.0'" if kind == "text" else ("-1" if kind == "int" else "-1.0")
        exprs[c] = f"CASE WHEN CAST({c} AS VARCHAR) IN (SELECT v FROM r_{c}) THEN {code} ELSE {c} END"
    return ", ".join(ctes), exprs


# ------------------------------------------------------------------ T09

_T09_COLS = {"age": "int", "job": "text", "marital": "text", "education": "text", "contact": "text",
             "campaign": "int", "balance": "double", "duration": "double", "previous": "double"}
_t09_cte, _t09_expr = _rare_sql("bank", _T09_COLS, RARE_T)


@register("t09_group_rare", sql_with(", " + _t09_cte + "\nSELECT id, " + ", ".join(
    f"{_t09_expr[c]} AS {c}" for c in _T09_COLS) + " FROM bank"))
def t09_group_rare(spark, d):
    b = bank_view(spark, d).select("id", *_T09_COLS)
    rare = FE.fit_rare(b, RARE_T, ROLES)
    return FE.apply_rare(b, rare)


# ------------------------------------------------------------------ T10

def _qbin_sql(src: str, cols: list[str], q: int) -> tuple[str, dict]:
    ps = ", ".join(str(i / q) for i in range(q + 1))
    ctes = [f"e_{c} AS (SELECT list_sort(list_distinct(quantile_cont({_dbl(c)}, [{ps}]))) AS e FROM {src})"
            for c in cols]
    exprs = {c: (f"CASE WHEN {c} IS NULL OR len((SELECT e FROM e_{c})) < 2 THEN NULL "
                 f"ELSE CAST(greatest(len(list_filter((SELECT e FROM e_{c}), lambda x: x < {_dbl(c)})) - 1, 0) AS INTEGER) END")
             for c in cols}
    return ", ".join(ctes), exprs


_t10_cte, _t10_expr = _qbin_sql("bank", list(FE.BIN_COLS), Q)


@register("t10_quantile_bins", sql_with(", " + _t10_cte + "\nSELECT id, " + ", ".join(
    f"{_t10_expr[c]} AS {c}_qbin" for c in FE.BIN_COLS) + " FROM bank"))
def t10_quantile_bins(spark, d):
    b = bank_view(spark, d).select("id", *FE.BIN_COLS)
    return FE.apply_qbins(b, FE.fit_qbins(b, list(FE.BIN_COLS), Q)).select("id", *[f"{c}_qbin" for c in FE.BIN_COLS])


# ------------------------------------------------------------------ T11-T13

@register("t11_t13_interactions", sql_with(
    ", dc AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT contact AS v FROM bank))\n"
    "SELECT id, round(CAST(duration AS DOUBLE) / CASE WHEN campaign = 0 THEN 1 ELSE campaign END, 6) AS duration_per_campaign, "
    "round(CAST(duration AS DOUBLE) * dc.code, 6) AS duration_x_contact, "
    "round(balance / nullif(CAST(age AS DOUBLE), 0), 6) AS balance_over_age "
    "FROM bank JOIN dc ON dc.v = bank.contact"))
def t11_t13_interactions(spark, d):
    b = bank_view(spark, d).select("id", "age", "contact", "balance", "duration", "campaign")
    b = C.apply_ordinal(b, C.fit_ordinal(b, ["contact"]))
    out = FE.add_interactions(b, add_all=True)
    return out.select("id", *[r6(c).alias(c) for c in ("duration_per_campaign", "duration_x_contact",
                                                        "balance_over_age")])


# ------------------------------------------------------------------ T15

def _t15_sql() -> str:
    cte = []
    cte.append(", ".join(
        f"d_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM "
        f"(SELECT DISTINCT {c} AS v FROM bank WHERE split = 'train'))" for c in CAT))
    joins = " ".join(f"LEFT JOIN d_{c} ON d_{c}.v = bank.{c}" for c in CAT)
    cte.append("e0 AS (SELECT id, age, " + ", ".join(f"CAST(coalesce(d_{c}.code, 0) AS INTEGER) AS {c}" for c in CAT)
               + f", balance, duration, campaign, previous, y, split FROM bank {joins})")
    cte.append(f"cq AS (SELECT quantile_cont({_dbl('duration')}, {CAP_Q}) AS d, "
               f"quantile_cont({_dbl('campaign')}, {CAP_Q}) AS c FROM e0)")
    cte.append("e1 AS (SELECT id, age, " + ", ".join(CAT) + ", "
               "CASE WHEN balance > -1 THEN ln(1 + balance) END AS balance, "
               f"CASE WHEN duration IS NULL THEN NULL ELSE least({_dbl('duration')}, (SELECT d FROM cq)) END AS duration, "
               f"CASE WHEN campaign IS NULL THEN NULL ELSE least({_dbl('campaign')}, (SELECT c FROM cq)) END AS campaign, "
               "previous, y, split FROM e0)")
    kinds = {"age": "int", **{c: "int" for c in CAT}, "balance": "double", "duration": "double",
             "campaign": "double", "previous": "double"}
    rc, rx = _rare_sql("e1", kinds, RARE_T)
    cte.append(rc)
    cte.append("e2 AS (SELECT id, " + ", ".join(f"{rx[c]} AS {c}" for c in kinds) + ", y, split FROM e1)")
    qc, qx = _qbin_sql("e2", list(FE.BIN_COLS), Q)
    cte.append(qc)
    body = ("SELECT id, age, " + ", ".join(CAT) + ", round(balance, 6) AS balance, round(duration, 6) AS duration, "
            "round(campaign, 6) AS campaign, round(previous, 6) AS previous, y, split, "
            + ", ".join(f"{qx[c]} AS {c}_qbin" for c in FE.BIN_COLS) + ", "
            "round(duration / CASE WHEN campaign = 0 THEN 1 ELSE campaign END, 6) AS duration_per_campaign, "
            "round(duration * contact, 6) AS duration_x_contact, "
            "round(balance / nullif(CAST(age AS DOUBLE), 0), 6) AS balance_over_age FROM e2")
    return sql_with(", " + ",\n".join(cte) + "\n" + body)


@register("t15_feature_chain", _t15_sql())
def t15_feature_chain(spark, d):
    b = bank_materialized(spark, d)
    codes = C.fit_ordinal(b.where(F.col("split") == "train"), CAT)
    b = C.apply_ordinal(b, codes)
    out = FE.engineer(b, ROLES, cap_pct=CAP_Q, log1p_balance=True, rare_threshold=RARE_T,
                      quantile_bins=Q, add_all_interactions=True)
    dbl = ["balance", "duration", "campaign", "previous", "duration_per_campaign", "duration_x_contact",
           "balance_over_age"]
    return out.select(*[r6(c).alias(c) if c in dbl else F.col(c) for c in out.columns])


_ = ALL
