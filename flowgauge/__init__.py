"""Spark jobs that label, balance, evaluate and report network-flow tables."""
