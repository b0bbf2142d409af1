"""Composite analytics and declarative feed definitions."""
