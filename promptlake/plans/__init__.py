"""Stages composed to pipelines, and the registered queries."""
