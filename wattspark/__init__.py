"""wattspark: energy-telemetry analytics expressed as Spark DataFrame plans.

Every public operator is a function ``DataFrame -> DataFrame`` (or a small
helper returning a Column expression), so a chain of them is one lazy logical
plan that Catalyst optimises as a whole.  The most used entry points are
re-exported here; the subpackages hold the rest.
"""

__version__ = "0.1.0"

from wattspark.session import build_session, tune_shuffle  # noqa: E402,F401
from wattspark.sources.exports import read_exports, read_routed, write_exports  # noqa: E402,F401
from wattspark.sources.telemetry import (  # noqa: E402,F401
    ingest_exports, read_telemetry, write_telemetry,
)
from wattspark.plans.preprocess import (  # noqa: E402,F401
    prep_k8s, prep_kepler, prep_pdu, prep_proxmox, prep_scaphandre,
    prep_scaphandre_host, prep_scaphandre_vm,
)
from wattspark.plans.datasets import energy_dataset, vm_power_dataset  # noqa: E402,F401
from wattspark.plans.selection import (  # noqa: E402,F401
    TelemetrySpec, inventory_ids, run_plugin, select_all_plugins, select_telemetry,
)
from wattspark.plans.runs import build_dataset, process_exports  # noqa: E402,F401
from wattspark.plans.workflows import (  # noqa: E402,F401
    anomaly_workflow, batch_score, energy_workflow, vm_power_workflow,
)
