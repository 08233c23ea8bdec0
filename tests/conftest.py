import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from goldleaf.session import build_session, checkpoint_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("goldleaf-tests", cpus="*", shuffle_partitions=8)
    checkpoint_root(s)  # tests run without a cluster: register a local folder only if none is configured
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark, request):
    from goldleaf.session import scratch_path

    return scratch_path(spark, request.node.name.replace("[", "_").replace("]", "_"))
