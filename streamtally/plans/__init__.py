"""Staging, intermediate and mart models as DataFrame -> DataFrame functions."""
