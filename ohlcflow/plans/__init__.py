"""Multi-step jobs (silver, layers, chain), skew handling, storage, sizing.

Submodules are imported directly (``from ohlcflow.plans.layers import
run_layers``) to keep package import light.
"""
