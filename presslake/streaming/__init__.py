"""presslake.streaming"""
