"""sift: a data-quality gate for batch tables on Spark."""

from sift.plans.gate import Gate, GateResult, plan_gate, run_folder, run_gate
from sift.sources.rulefile import ConfigError, GateConfig, load_config, load_folder

__all__ = [
    "ConfigError",
    "Gate",
    "GateConfig",
    "GateResult",
    "load_config",
    "load_folder",
    "plan_gate",
    "run_folder",
    "run_gate",
]
