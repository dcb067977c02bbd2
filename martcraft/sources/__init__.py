"""Input tables: the base-table reader and the mart inputs built on them."""

from martcraft.sources.fixtures import fixture_inputs
from martcraft.sources.inputs import Inputs, inputs_from_paths, inputs_from_tables
from martcraft.sources.tables import read_table

__all__ = ["Inputs", "fixture_inputs", "inputs_from_paths", "inputs_from_tables", "read_table"]
