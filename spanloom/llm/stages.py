"""Cut points of long jobs: tables in the cluster's shared folder."""

from spanloom.session import discard, written

__all__ = ["discard", "written"]
