"""Registered queries. Importing the modules below fills the registry."""
