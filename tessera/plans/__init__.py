from tessera.plans.catalog import REGISTRY
from tessera.plans.oracle import ORACLE

__all__ = ["REGISTRY", "ORACLE"]
