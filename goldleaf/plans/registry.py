"""All registered queries (importing the modules fills the registry)."""

from goldleaf.plans import workload  # noqa: F401
from goldleaf.plans import workload_silver  # noqa: F401
from goldleaf.plans.workload import ORACLE, QUERIES  # noqa: F401
from goldleaf.plans import workload_sources  # noqa: F401,E402
from goldleaf.plans import workload_features  # noqa: F401,E402
from goldleaf.plans import workload_streaming  # noqa: F401,E402
from goldleaf.plans import workload_tables  # noqa: F401,E402
