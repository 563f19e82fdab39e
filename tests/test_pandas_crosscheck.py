"""Independent pandas cross-check of the processing plans.

The stand-in long tables at sf0.001 are small, so they are brought to pandas
here (test only) and processed with pandas' own pivot / NaN / merge rules;
the Spark plans must give the same rows.
"""

import numpy as np
import pandas as pd
import pytest

from conftest import SF001
from wattspark.catalog import queries as Q
from wattspark.plans import datasets
from wattspark.schemas import SOURCES, VM_PROXMOX_COLUMNS, VM_SCAPH_AGG


def _pdf(spark, source):
    pdf = Q.long(spark, SF001, source).toPandas()
    pdf["_time"] = pd.to_datetime(pdf["_time"])
    return pdf


def _wide_pandas(pdf, source):
    src = SOURCES[source]
    if source == "k8s":
        pdf = pdf[pdf["container_name"].notna() & pdf["pod_name"].notna()]
    if src.value_is_text:
        pdf = pdf.assign(_value=pd.to_numeric(pdf["_value"], errors="coerce"))
    parts = []
    for _, one in pdf.groupby("_file"):                  # one pivot per export file
        w = one.pivot_table(index=src.index, columns="_field", values="_value", aggfunc="mean")
        parts.append(w.reset_index())
    out = pd.concat(parts, ignore_index=True)
    if source.startswith("scaphandre"):
        out = out.dropna().drop_duplicates()
    return out


def _rows(df_or_pdf, cols):
    if not isinstance(df_or_pdf, pd.DataFrame):
        df_or_pdf = df_or_pdf.select(*[f"`{c}`" for c in cols]).toPandas()
    vals = df_or_pdf[cols].copy()
    for c in cols:
        if np.issubdtype(vals[c].dtype, np.datetime64):
            vals[c] = vals[c].astype("int64")
    out = []
    for row in vals.itertuples(index=False):
        out.append(tuple("nan" if isinstance(v, float) and np.isnan(v) else
                         (round(v, 9) if isinstance(v, float) else v) for v in row))
    return sorted(out, key=repr)


@pytest.mark.parametrize("source", ["k8s", "kepler", "proxmox", "scaphandre_vm", "scaphandre_host"])
def test_wide_tables_match_pandas(spark, source):
    expected = _wide_pandas(_pdf(spark, source), source)
    got = Q.wide(spark, SF001, source)
    cols = [c for c in expected.columns if c in got.columns]
    assert set(SOURCES[source].index) <= set(cols)
    assert _rows(got, cols) == _rows(expected, cols)
    # declared fields that pandas never made a column for are all missing
    for c in set(got.columns) - set(expected.columns) - {"disk_free_gb", "disk_total_gb",
                                                        "disk_used_gb", "disk_usage_percent"}:
        assert got.where(f"`{c}` is not null").count() == 0


def test_energy_dataset_matches_pandas(spark):
    k8s = _wide_pandas(_pdf(spark, "k8s"), "k8s")
    kep = _wide_pandas(_pdf(spark, "kepler"), "kepler")
    for w in (k8s, kep):
        w["_time"] = w["_time"].dt.floor("1D")
    keys = ["_time", "container_name", "namespace", "pod_name"]
    kep = kep.groupby(keys, as_index=False).agg({"kepler_container_joules_total": "sum"})
    kcols = keys + ["cpu_usage_nanocores", "memory_usage_bytes", "logsfs_used_bytes",
                    "logsfs_capacity_bytes"]
    m = pd.merge(k8s[kcols].dropna(), kep.dropna(), on=keys, how="inner")
    m["cpu_millicores"] = m["cpu_usage_nanocores"] / 1e6
    m["memory_usage_mb"] = m["memory_usage_bytes"] / (1024 ** 2)
    m["logsfs_usage_percent"] = np.where(m["logsfs_capacity_bytes"] > 0,
                                         m["logsfs_used_bytes"] / m["logsfs_capacity_bytes"] * 100, 0.0)
    m["container_power_watts"] = m["kepler_container_joules_total"] / 60
    cols = keys + ["cpu_millicores", "memory_usage_mb", "logsfs_usage_percent", "container_power_watts"]
    expected = m[cols].dropna()
    got = datasets.energy_dataset(Q.wide(spark, SF001, "k8s"), Q.wide(spark, SF001, "kepler"), "1D")
    assert _rows(got, cols) == _rows(expected, cols)


def test_vm_power_dataset_matches_pandas(spark):
    prox = _wide_pandas(_pdf(spark, "proxmox"), "proxmox")
    prox["disk_free_gb"] = prox["disk_free"] / 1024 ** 3
    prox["disk_total_gb"] = prox["disk_total"] / 1024 ** 3
    prox["disk_used_gb"] = (prox["disk_total"] - prox["disk_free"]) / 1024 ** 3
    with np.errstate(divide="ignore", invalid="ignore"):
        prox["disk_usage_percent"] = 100 * (1 - prox["disk_free"] / prox["disk_total"])
    vm = _wide_pandas(_pdf(spark, "scaphandre_vm"), "scaphandre_vm")
    prox = prox[prox["vm_name"].str.contains("k8s", na=False)].copy()
    vm = vm[vm["vm_name"].str.contains("k8s", na=False)].copy()
    for w in (prox, vm):
        w["_time"] = w["_time"].dt.floor("1D")
    agg = vm.groupby(["_time", "vm_id"], as_index=False).agg(VM_SCAPH_AGG)
    m = pd.merge(prox[VM_PROXMOX_COLUMNS].dropna(), agg, on=["_time", "vm_id"], how="inner")
    m["uptime_hours"] = m["uptime"] / 3600
    m["vm_power_watts"] = m["scaph_process_power_consumption_microwatts"] / 1e6
    expected = m.dropna()
    got = datasets.vm_power_dataset(Q.wide(spark, SF001, "proxmox"),
                                    Q.wide(spark, SF001, "scaphandre_vm"), "1D")
    cols = list(expected.columns)
    assert set(cols) == set(got.columns)
    assert _rows(got, cols) == _rows(expected, cols)


@pytest.mark.parametrize("source", ["k8s", "kepler", "proxmox", "scaphandre_vm"])
def test_discover_mode_has_the_dynamic_pivot_columns(spark, source):
    from wattspark.plans import preprocess

    expected = _wide_pandas(_pdf(spark, source), source)
    prep = {"k8s": preprocess.prep_k8s, "kepler": preprocess.prep_kepler,
            "proxmox": preprocess.prep_proxmox, "scaphandre_vm": preprocess.prep_scaphandre_vm}[source]
    got = prep(Q.long(spark, SF001, source), fields="discover")
    derived = {"disk_free_gb", "disk_total_gb", "disk_used_gb", "disk_usage_percent"}
    assert set(got.columns) - derived == set(expected.columns)
    assert _rows(got, list(expected.columns)) == _rows(expected, list(expected.columns))
