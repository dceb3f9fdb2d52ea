"""End-to-end jobs."""

from acctweave.plans.jobs import match_feed, prepare_feed, publish, standardize_feed

__all__ = ["match_feed", "prepare_feed", "publish", "standardize_feed"]
