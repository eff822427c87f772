"""Staging models, marts, monitoring views and the jobs built from the operators."""
