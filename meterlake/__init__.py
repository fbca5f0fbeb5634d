"""Usage and cost analytics on Spark: sources, facts, cards, checks, sinks."""
