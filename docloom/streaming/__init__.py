"""docloom.streaming"""
