"""Marts, reports, dashboard panels, models and jobs built from operators."""
