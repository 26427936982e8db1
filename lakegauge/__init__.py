"""lakegauge: checks and baselines for partitioned tables, on Spark DataFrames."""

from lakegauge.contract import Contract, ContractError, load_contracts
from lakegauge.session import build_session

__all__ = ["Contract", "ContractError", "build_session", "load_contracts"]
