from quayside.plans.landing import LandingConfig, LandingResult, run_landing
from quayside.plans.steps import copy_pending, setup_ledger

__all__ = ["LandingConfig", "LandingResult", "copy_pending", "run_landing", "setup_ledger"]
