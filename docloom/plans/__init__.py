"""docloom.plans"""
