"""Multi-step jobs composed from sources and operators."""
