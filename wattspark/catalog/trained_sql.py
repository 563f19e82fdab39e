"""DuckDB SQL of the queries in :mod:`wattspark.catalog.trained`."""

from __future__ import annotations

from wattspark.schemas import ENERGY_FEATURES, VM_FEATURES, VM_TARGET


def scaled_sql(rows: str, columns: list[str]) -> str:
    """The rows with ``z0``, ``z1``, ... (columns divided by their population deviation) and
    ``pos``, their place in the order of their content."""
    stats = ", ".join(f"CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0 "
                      f"ELSE stddev_pop({c}) END AS s{k}" for k, c in enumerate(columns))
    z = ", ".join(f"{c} / s{k} AS z{k}" for k, c in enumerate(columns))
    return (f"(SELECT d.*, {z}, row_number() OVER (ORDER BY _time, vm_id, {', '.join(columns)}) - 1 "
            f"AS pos FROM {rows} d CROSS JOIN (SELECT {stats} FROM {rows} d2) st)")


def linear_training_sql(scaled: str, x: list[str], y: list[str], batch: int, epochs: int,
                        rate: float) -> str:
    """CTEs ``z``, ``mom`` (sums per batch) and ``run``: one row per Adam step of a linear
    network with weights w(i * outputs + j) and biases after them."""
    f, k = len(x), len(y)
    p = (f + 1) * k
    one = [*x, "1.0"]
    sums = [f"sum({a} * {b}) AS xx{i}_{j}" for i, a in enumerate(one) for j, b in enumerate(one)]
    sums += [f"sum({a} * {b}) AS xy{i}_{j}" for i, a in enumerate(one) for j, b in enumerate(y)]
    sums += [f"sum({b} * {b}) AS yy{j}" for j, b in enumerate(y)]
    w = [[f"w{i * k + j}" for i in range(f + 1)] for j in range(k)]       # per output, bias last
    grads = [f"2 / (n * {k}) * ({' + '.join(f'xx{i}_{a} * {w[j][a]}' for a in range(f + 1))} - xy{i}_{j})"
             f" AS g{i * k + j}" for i in range(f + 1) for j in range(k)]
    loss = " + ".join(
        [f"xx{a}_{b} * {w[j][a]} * {w[j][b]}" for j in range(k) for a in range(f + 1) for b in range(f + 1)]
        + [f"yy{j} - 2 * ({' + '.join(f'xy{a}_{j} * {w[j][a]}' for a in range(f + 1))})" for j in range(k)])
    every = range(p)
    keep = ", ".join(f"w{i}" for i in every)
    moments = ", ".join(f"0.9 * m{i} + 0.1 * g{i} AS m{i}, 0.999 * v{i} + 0.001 * g{i} * g{i} AS v{i}"
                        for i in every)
    steps = ", ".join(f"w{i} - {rate} * (m{i} / (1 - 0.9 ** t)) / (sqrt(v{i} / (1 - 0.999 ** t)) + 1e-8)"
                      for i in every)
    names = ", ".join(f"w{i}" for i in every) + ", " + ", ".join(f"m{i}, v{i}" for i in every)
    mv = ", ".join(f"m{i}, v{i}" for i in every)
    return f"""z AS MATERIALIZED (SELECT * FROM {scaled} s0),
  mom AS MATERIALIZED (SELECT pos // {batch} AS batch, count(*)::DOUBLE AS n, {', '.join(sums)}
    FROM z GROUP BY 1),
  run(t, loss, n, {names}) AS (
    SELECT 0, 0::DOUBLE, 0::DOUBLE, {', '.join(['0::DOUBLE'] * (3 * p))}
    UNION ALL
    SELECT t, loss, n, {steps}, {mv} FROM (
      SELECT t, loss, n, {keep}, {moments} FROM (
        SELECT r.t + 1 AS t, b.n AS n, ({loss}) / (b.n * {k}) AS loss, {keep}, {mv}, {', '.join(
            g.replace('(n *', '(b.n *') for g in grads)}
        FROM run r JOIN mom b ON b.batch = r.t % (SELECT count(*) FROM mom)
        WHERE r.t < {epochs} * (SELECT count(*) FROM mom)) g1) g2)"""


def oracle_sql() -> dict[str, str]:
    from wattspark.catalog import oracle as base
    from wattspark.catalog.trained import BATCH, CODED_FEATURES, EPOCHS, LINEAR_FEATURES, RATE

    o: dict[str, str] = {}
    vm, ekeys = base.vm_dataset_sql(), "_time, container_name, namespace, pod_name"
    linear = linear_training_sql(scaled_sql(vm, [*LINEAR_FEATURES, VM_TARGET]), ["z0", "z1", "z2"], ["z3"],
                                 BATCH, EPOCHS, RATE)
    last = "(SELECT * FROM run ORDER BY t DESC LIMIT 1)"
    weights = " UNION ALL ".join(
        f"SELECT '{name}' AS name, CAST({EPOCHS} AS INTEGER) AS epoch, w{k} AS value FROM {last} l{k}"
        for k, name in enumerate([*LINEAR_FEATURES, "bias"]))
    o["sync_training"] = f"""WITH RECURSIVE {linear},
  out AS ({weights} UNION ALL
    SELECT 'loss', CAST((t - 1) // (SELECT count(*) FROM mom) + 1 AS INTEGER), sum(loss * n) / sum(n)
    FROM run WHERE t > 0 GROUP BY 1, 2)
SELECT CAST(u.workers AS INTEGER) AS workers, name, epoch, round(value, 6) AS value
FROM out CROSS JOIN (VALUES (1), (2)) u(workers)"""
    o["batch_score_dense"] = f"""WITH RECURSIVE {linear}
SELECT _time, vm_id, round(z0 * w0 + z1 * w1 + z2 * w2 + w3, 6) AS prediction FROM z CROSS JOIN {last} l"""
    coder = linear_training_sql(scaled_sql(vm, CODED_FEATURES), ["z0", "z1"], ["z0", "z1"], BATCH, EPOCHS, RATE)
    o["anomaly_errors"] = f"""WITH RECURSIVE {coder},
  e AS (SELECT _time, vm_id, ((z0 * w0 + z1 * w2 + w4 - z0) ** 2 + (z0 * w1 + z1 * w3 + w5 - z1) ** 2) / 2 AS e
        FROM z CROSS JOIN {last} l),
  c AS (SELECT avg(e) + 3 * stddev_pop(e) AS cut FROM e)
SELECT _time, vm_id, round(e, 6) AS reconstruction_error, round(cut, 6) AS threshold, e > cut AS is_anomaly
FROM e CROSS JOIN c"""
    rounded = ", ".join(f"round({c}, 4)" for c in ENERGY_FEATURES)
    o["forest_unlimited"] = (
        f"SELECT {ekeys}, round(container_power_watts, 6) AS y_true, round(avg(container_power_watts) OVER "
        f"(PARTITION BY {rounded}), 6) AS y_pred FROM {base.split_sql()} s WHERE split = 'train'")
    rounded = ", ".join(f"round({c}, 4)" for c in VM_FEATURES)
    o["forest_unlimited_scored"] = (
        f"SELECT _time, vm_id, round({VM_TARGET}, 6) AS y_true, round(avg({VM_TARGET}) OVER "
        f"(PARTITION BY {rounded}), 6) AS y_pred FROM {vm} v")
    o["importance_planted"] = ("SELECT * FROM (VALUES ('cpu_millicores', 1.0::DOUBLE), ('constant', 0.0::DOUBLE)) "
                               "t(feature, importance)")
    o["vm_power_dataset_1min"] = f"SELECT * FROM {base.vm_dataset_sql('minute', base.closer)} v"
    o["processed_two_outputs"] = (
        f"SELECT 'host' AS route, _time, url, scaph_host_power_microwatts AS microwatts "
        f"FROM {base.wide_scaph('scaphandre_host')} h UNION ALL SELECT 'vm', _time, url, "
        f"scaph_process_power_consumption_microwatts FROM {base.wide_scaph('scaphandre_vm')} v")
    return o
