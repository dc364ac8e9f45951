"""Chains of operators from feeds to marts, and the registered queries."""
