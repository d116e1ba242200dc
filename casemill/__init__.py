"""Case and complaint analytics as Spark DataFrame functions."""

from casemill.params import Params
from casemill.session import build_session, configure, stage

__all__ = ["Params", "build_session", "configure", "stage"]
