"""Inputs and outputs: derived weather logs, forecast payloads, topics, cities."""
