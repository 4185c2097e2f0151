"""Session-step decay histories (C7 pair keys, C8 user key; W31, W32).

Every distinct (user, time) over candidates and interactions is a *step*
(1-based per user).  For a candidate at step ``s`` and the key's earlier
interactions ``i`` (step ``s_i < s``):

* ``{col}_decay_score_{alias}`` = sum of v_i * exp(f * (s - s_i)),
  ``f = ln(0.5) / half_life``;
* over the last N earlier interactions (N in ``windows``): mean and sample
  std of the decayed values, mean and sum of the raw values;
* ``{col}_{alias}``: raw value of the latest earlier interaction (pair keys).

No candidate x interaction pairs are formed.

Decay sums use blocks of ``K`` steps with block-anchored weights
``a_i = v_i * exp(-f * (s_i - K*c))``: a running sum inside (key, block)
covers the candidate's own block, and a bounded window over the previous
``L`` block totals covers earlier blocks.  Interactions more than ``L*K``
steps back have weight ``exp(f * L * K) < exp(-745)``, which is exactly 0.0
in double arithmetic, the same value a pairwise computation produces, so
nothing is lost.  Each partition holds at most K steps of one key.

Last-N statistics come from an array of the last ``max(windows)``
interactions carried by the last interaction of every (keys, time) (built in
index blocks with a halo of ``max(windows) - 1`` rows), picked up by a strict
as-of join. Interactions at one time are ordered by their values.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsignals.operators.asof import asof_join
from recsignals.operators.frames import row_index

INDEX_BLOCK_ROWS = 4096


def session_steps(candidates: DataFrame, interactions: DataFrame, user: str, ts: str) -> DataFrame:
    """(user, ts, interaction_step): dense 1-based index of the distinct
    times of a user over both tables (W31)."""
    times = candidates.select(user, ts).union(interactions.select(user, ts)).distinct()
    return row_index(times, [user], ts, alias="interaction_step")


def _block_size(f: float) -> tuple[int, int]:
    k = max(1, int(100 * math.log(2) / abs(f)))           # anchors stay below 2^100
    reach = int(math.ceil(745.2 / (abs(f) * k))) + 1      # beyond: weights underflow to 0.0
    return k, reach


def _decayed(arr, c, f, s_now):
    return F.transform(arr, lambda e: e[c] * F.exp(f * (s_now - e["s"])))


def _field(arr, c):
    return F.transform(arr, lambda e: e[c])


def decay_columns(cols, windows, alias, last_raw=True) -> list[str]:
    out = [f"{c}_decay_score_{alias}" for c in cols]
    for c in cols:
        for n in windows:
            out += [f"{c}_weighted_{n}roll_step_mean_{alias}", f"{c}_weighted_{n}roll_step_std_{alias}",
                    f"{c}_{n}roll_step_mean_{alias}", f"{c}_{n}roll_step_sum_{alias}"]
    if last_raw:
        out += [f"{c}_{alias}" for c in cols]
    return out


def session_decay_history(train: DataFrame, interactions: DataFrame, cols: list[str], keys: list[str],
                          user: str, ts: str, windows=(3, 12), half_life: float = 3.0,
                          decay_value: float = math.log(0.5), alias: str = "fashion",
                          last_raw: bool = True) -> DataFrame:
    """Attach decay scores and last-N statistics to every ``train`` row.

    ``keys``: [user, item] (C7) or [user] (C8)."""
    from recsignals.session import stage

    if not cols:
        raise ValueError("cols must list the interaction columns")
    f = decay_value / half_life
    if f >= 0:
        raise ValueError("decay_value must be negative: older interactions weigh less")
    # Half-life decay (ln 0.5 over an integer number of steps) is evaluated
    # in base 2, with anchored sums kept per step residue mod h: terms whose
    # gap is a multiple of h then combine as exact powers of two, so dyadic
    # results (0.5, 0.0390625, ...) come out exact, as a direct exp would.
    dyadic = abs(decay_value - math.log(0.5)) < 1e-12 and float(half_life).is_integer()
    h = int(half_life) if dyadic else 1
    k, reach = _block_size(f)
    k = max(h, (k // h) * h)
    steps = stage(session_steps(train, interactions, user, ts), "steps")
    inter = stage(interactions.select(*keys, ts, *cols).join(steps, [user, ts]), "steps-inter")
    cand = train.select(*keys, ts).distinct().join(steps, [user, ts])

    # ---- decay sums -------------------------------------------------------
    blk = F.floor(F.col("interaction_step") / k).cast("bigint")
    rel = F.col("interaction_step") - F.col("__c") * k          # in [0, k)
    res = rel % h
    if dyadic:
        scale = F.pow(F.lit(2.0), ((rel - res) / h).cast("double"))   # exact power of two

        def anchored(c, rho):
            return F.when(res == rho, F.col(c).cast("double") * scale).otherwise(F.lit(0.0))

        def block_factor(delta):          # delta = c - c' >= 1 blocks back
            return F.pow(F.lit(2.0), (-delta * (k // h)).cast("double"))

        def final(sums, rel_s):
            r = rel_s % h
            q = ((rel_s - r) / h).cast("double")
            return sum((sums[rho] * F.pow(F.lit(2.0), -q)
                        * F.pow(F.lit(2.0), ((F.lit(rho) - r) / h).cast("double")) for rho in range(h)),
                       F.lit(0.0))
    else:
        def anchored(c, rho):
            return F.col(c).cast("double") * F.exp(-f * rel)

        def block_factor(delta):
            return F.exp(f * k * delta)

        def final(sums, rel_s):
            return sums[0] * F.exp(f * rel_s)

    names = {(c, rho): f"__a_{c}_{rho}" for c in cols for rho in range(h)}
    ia = inter.withColumn("__c", blk).select(
        *keys, "__c", "interaction_step", F.lit(1).alias("__side"),
        *[anchored(c, rho).alias(nm) for (c, rho), nm in names.items()])
    ca = cand.withColumn("__c", blk).select(*keys, ts, "__c", "interaction_step", F.lit(0).alias("__side"))
    # earlier-block totals, seen from each probed block through a bounded range
    btot = ia.groupBy(*keys, "__c").agg(*[F.sum(nm).alias(nm) for nm in names.values()])
    probed = ca.select(*keys, "__c").distinct()
    tb = (btot.withColumn("__p", F.lit(0))
          .unionByName(probed.withColumn("__p", F.lit(1)), allowMissingColumns=True))
    wb = Window.partitionBy(*keys).orderBy("__c").rangeBetween(-reach, -1)
    prev = F.collect_list(F.struct("__c", *names.values())).over(wb)  # <= reach entries

    def carried(nm):
        return F.aggregate("__prev", F.lit(0.0), lambda acc, e: acc + F.coalesce(
            e[nm] * block_factor(F.col("__c") - e["__c"]), F.lit(0.0)))

    earlier = tb.select(*keys, "__c", "__p", prev.alias("__prev")).where(F.col("__p") == 1).select(
        *keys, "__c", *[carried(nm).alias(f"__e{nm}") for nm in names.values()])
    u = ca.unionByName(ia, allowMissingColumns=True)
    w = (Window.partitionBy(*keys, "__c").orderBy("interaction_step", "__side")
         .rowsBetween(Window.unboundedPreceding, 0))
    inblock = u.select(*keys, ts, "__c", "interaction_step", "__side",
                       *[F.sum(nm).over(w).alias(f"__r{nm}") for nm in names.values()]).where(F.col("__side") == 0)
    rel_s = F.col("interaction_step") - F.col("__c") * k
    dec = inblock.join(earlier, [*keys, "__c"], "left").select(
        *keys, ts, "interaction_step", *[
            final({rho: F.coalesce(F.col(f"__r{names[(c, rho)]}"), F.lit(0.0))
                   + F.coalesce(F.col(f"__e{names[(c, rho)]}"), F.lit(0.0)) for rho in range(h)}, rel_s)
            .alias(f"{c}_decay_score_{alias}") for c in cols])

    # ---- last-N arrays ----------------------------------------------------
    nmax = max(windows)
    # Interactions of a key at one time follow in the order of their values; the array at the last of them holds them all.
    idx = row_index(inter, keys, ts, tiebreak=list(cols), alias="__j")
    g = F.floor((F.col("__j") - 1) / INDEX_BLOCK_ROWS).cast("bigint")
    halo = ((F.col("__j") - 1) % INDEX_BLOCK_ROWS) >= INDEX_BLOCK_ROWS - (nmax - 1)
    idx = (idx.withColumn("__h", F.explode(F.when(halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
           .withColumn("__g", g + F.col("__h")))
    wl = Window.partitionBy(*keys, "__g").orderBy("__j").rowsBetween(-(nmax - 1), 0)
    item = F.struct(F.col("__j").alias("j"), F.col("interaction_step").alias("s"), *[F.col(c).cast("double").alias(c) for c in cols])
    follows = F.lead(ts).over(Window.partitionBy(*keys, "__g").orderBy("__j"))
    # Of peers the last in a block stays; peers in two blocks are ties of the as-of join, where the later array is the greater.
    lastn = (idx.select(*keys, ts, "__h", follows.alias("__follows"), F.array_sort(F.collect_list(item).over(wl)).alias("__arr"))
             .where((F.col("__h") == 0) & (F.col("__follows").isNull() | (F.col("__follows") != F.col(ts)))))
    att = asof_join(dec, lastn, keys, ts, strict=True, right_cols=["__arr"], probes_from=train.select(*keys, ts), times_from=inter, few_ties=True)

    # In steps, each a projection of its own: a lambda that holds an aggregate computes it once per element.
    s_now = F.col("interaction_step")
    sz = F.size(F.col("__arr"))
    att = att.withColumns({f"__last{n}": F.slice(F.col("__arr"), F.greatest(sz - n + 1, F.lit(1)), n) for n in windows})
    att = att.withColumns({f"__w{n}_{c}": _decayed(F.col(f"__last{n}"), c, f, s_now) for n in windows for c in cols}
                          | {f"__s{n}_{c}": F.aggregate(_field(F.col(f"__last{n}"), c), F.lit(0.0), lambda a, x: a + x) for n in windows for c in cols}
                          | {f"__n{n}": F.size(F.col(f"__last{n}")).cast("double") for n in windows})
    att = att.withColumns({f"__m{n}_{c}": F.aggregate(F.col(f"__w{n}_{c}"), F.lit(0.0), lambda a, x: a + x) / F.col(f"__n{n}") for n in windows for c in cols})
    outs = {}
    for n in windows:
        cnt = F.col(f"__n{n}")
        for c in cols:
            mean_w, total = F.col(f"__m{n}_{c}"), F.col(f"__s{n}_{c}")
            ss = F.aggregate(F.col(f"__w{n}_{c}"), F.lit(0.0), lambda a, x: a + (x - mean_w) * (x - mean_w))
            outs[f"{c}_weighted_{n}roll_step_mean_{alias}"] = F.when(cnt > 0, mean_w)
            outs[f"{c}_weighted_{n}roll_step_std_{alias}"] = F.when(cnt > 1, F.sqrt(ss / (cnt - 1)))
            outs[f"{c}_{n}roll_step_mean_{alias}"] = F.when(cnt > 0, total / cnt)
            outs[f"{c}_{n}roll_step_sum_{alias}"] = F.when(cnt > 0, total)
    if last_raw:
        for c in cols:
            outs[f"{c}_{alias}"] = F.element_at(F.col("__arr"), -1)[c]
    att = att.withColumns(outs)
    att = att.drop(*[c for c in att.columns if c.startswith("__")])
    new = decay_columns(cols, windows, alias, last_raw)
    fill = [c for c in new if not (last_raw and c in [f"{x}_{alias}" for x in cols])]
    res = train.join(att.drop("interaction_step"), [*keys, ts], "left")
    return res.fillna(0, subset=fill)
