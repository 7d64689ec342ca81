from matchstats.functions import scalar  # noqa: F401
