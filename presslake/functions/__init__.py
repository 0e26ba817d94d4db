"""presslake.functions"""
