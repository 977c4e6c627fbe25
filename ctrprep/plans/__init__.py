"""Declarative runs and the query catalogue."""

from ctrprep.plans.runner import Prepared, commit_outputs, prepare, read_run, write_outputs
from ctrprep.plans.spec import PrepSpec

__all__ = ["PrepSpec", "Prepared", "commit_outputs", "prepare", "read_run", "write_outputs"]
