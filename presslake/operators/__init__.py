"""presslake.operators"""
