"""The tables in which the publication and the proactive dialect differ from the defaults in ``vocab``."""

# All tables here must equal those of the dialects for right results.
PROACTIVE_SYNONYMS = {
    "start": ["begin", "initiate", "commence"],
    "small": ["tiny", "minimal", "modest"],
    "habit": ["routine", "practice", "pattern"],
    "process": ["method", "approach", "system"],
    "clarity": ["focus", "precision", "understanding"],
    "tool": ["resource", "aid", "instrument"],
    "reframe": ["rethink", "reposition", "recast"],
    "foundational": ["basic", "core", "essential"],
    "people": ["individuals", "team", "partners"],
    "transparency": ["openness", "honesty", "candor"],
}
PUBLICATION_SYNONYMS = {
    "start": ["begin", "initiate", "commence", "launch"],
    "small": ["tiny", "minimal", "basic", "modest"],
    "habit": ["routine", "practice", "pattern", "custom"],
    "process": ["method", "approach", "system", "procedure"],
    "clarity": ["focus", "precision", "understanding", "lucidity"],
    "tool": ["resource", "aid", "instrument", "device"],
    "reframe": ["rethink", "reposition", "recast", "redefine"],
    "foundational": ["basic", "core", "essential", "fundamental"],
    "transformational": ["evolving", "shifting", "revolutionary", "metamorphic"],
    "aspirational": ["visionary", "ambitious", "inspirational", "idealistic"],
    "people": ["individuals", "team", "partners", "stakeholders"],
    "transparency": ["openness", "honesty", "candor", "clarity"],
}
PROACTIVE_SUFFIXES = [
    " The user is feeling particularly overwhelmed this week.",
    " The user has tried other solutions without success and is feeling skeptical.",
    " The user is on a tight budget and needs low-cost solutions.",
    " The user has very limited free time and needs a time-efficient approach.",
]
PUBLICATION_SUFFIXES = [
    " The user is feeling particularly overwhelmed this week.",
    " The user has tried other solutions without success and is feeling skeptical.",
    " The user is on a tight budget and needs low-cost solutions.",
    " The user has very limited free time and needs a time-efficient approach.",
    " The user is dealing with family involvement, adding emotional layers.",
    " The user seeks long-term transformation beyond quick fixes.",
    " The user faces high-stakes decisions with ethical implications.",
    " The user involves multiple stakeholders with conflicting interests.",
    " The user is recovering from a setback and needs gentle restarts.",
    " The user has cultural or regional constraints influencing the approach.",
]
PUBLICATION_ATTRIBUTES = {
    "Aspirational": ["Affirming", "Proactive", "Knowledgeable", "Forward-looking", "Empathetic", "Inspirational", "Visionary", "Motivational"],
    "Transformational": ["Empathetic", "Insightful", "Principle-driven", "Clarifying", "Reflective", "Adaptive", "Innovative"],
    "Foundational": ["Encouraging", "Actionable", "Clear", "Practical", "Concise", "Supportive", "Structured", "Reliable"],
}
PUBLICATION_STEPS = {
    "Aspirational": ["Affirm the user's vision.", "Connect to long-term principles.", "Propose proactive next steps.", "Encourage sustained growth.", "Visualize future outcomes.", "Align with personal values."],
    "Transformational": ["Acknowledge the dilemma.", "Reframe around core values.", "Guide toward a clarifying choice.", "Suggest experimental adjustments.", "Evaluate potential shifts.", "Integrate feedback loops."],
    "Foundational": ["Acknowledge the user's problem.", "Reframe it using a core principle.", "Provide a concrete, foundational first step.", "Offer encouragement for consistency.", "Break down into manageable parts.", "Set immediate goals."],
}
#: (needed in the persona, context suffix, prompt suffix)
PROACTIVE_PAIRS = [
    ("", " The user has unlimited resources.", " What if budget wasn't an issue?"),
    ("", " The user is facing a tight deadline.", " I need a solution that is fast and effective."),
    ("", " This involves a team with conflicting opinions.", " How can I get my team to agree on this?"),
    ("Fitness Seeker", " The user is recovering from an injury.", " How can I adapt this for a recent injury?"),
]
PUBLICATION_PAIRS = [
    ("", " The user has unlimited resources and time.", " Resources no issue; best premium plan?"),
    ("", " Involves ethical dilemmas with stakeholders.", " How to handle moral conflicts?"),
    ("", " High-stakes scenario with tight deadlines.", " Urgent; quick but effective?"),
    ("", " Cultural adaptation needed for global context.", " Adjust for my region?"),
    ("", " Focus on measurable outcomes and KPIs.", " How to track progress?"),
]
#: By what the persona has, the first that it has: context and prompt suffixes.
PUBLICATION_PERSONA_PAIRS = {
    "Fitness Seeker": [(" Training for a specific event like marathon.", " Marathon prep; advanced tweaks?"), (" Recovering from injury.", " Post-injury; gentle start?"), (" Group fitness with friends.", " Involve buddies for motivation?"), (" Dietary integration.", " Combine with meal planning?")],
    "Relationship Manager": [(" Planning major life event like wedding.", " Wedding budget stress; tips?"), (" Disagreement on long-term goals.", " Different retirement visions; align?"), (" Involves children or family.", " Kids' expenses adding up?"), (" Debt management focus.", " How to pay off debt together?")],
    "Creative Professional": [(" Commercial project with deadline.", " Client deadline; pressure on?"), (" Seeking new voice or style.", " Style stale; fresh angle?"), (" Imposter syndrome.", " Feel like fraud; overcome?"), (" Collaboration with others.", " Co-write with partner?")],
    "Career Changer": [(" Mid-career switch.", " 40s pivot; risks?"), (" Skill gap analysis.", " What skills missing?"), (" Networking events.", " Best way to network?"), (" Resume overhaul.", " Update CV for new field?")],
    "Business Professional": [(" Team reorganization stress.", " Company restructure; adapt?"), (" Client negotiation.", " Tough client; strategies?"), (" Performance reviews.", " Prep for annual review?"), (" Delegation challenges.", " Hard to delegate; tips?")],
    "Social Host": [(" Small space hosting.", " Tiny apartment; not cramped?"), (" Dietary restrictions.", " Guests vegan/gluten-free?"), (" Theme party ideas.", " Themed event; suggestions?"), (" Budget-friendly decor.", " Cheap but nice setup?")],
    "Content Creator": [(" Repurpose content formats.", " Blog to video script?"), (" Ethical AI use.", " AI ethics; avoid plagiarism?"), (" SEO optimization.", " AI for SEO keywords?"), (" Audience engagement.", " Boost interaction with AI?")],
    "Parent": [(" Multiple children balancing.", " Three kids; manage all?"), (" ADHD or special needs.", " Child with ADHD; strategies?"), (" Homework battles.", " Kid hates homework; motivate?"), (" Extracurricular integration.", " Balance school and sports?")],
    "Team Member": [(" Remote work conflicts.", " Virtual team disputes?"), (" Feedback delivery.", " Give constructive criticism?"), (" Mediation role.", " Mediate between colleagues?"), (" Burnout prevention.", " Team burnout; address?")],
    "Style Seeker": [(" Capsule wardrobe build.", " Minimalist essentials?"), (" Event-specific outfit.", " Conference attire; comfy?"), (" Sustainable shopping.", " Eco-friendly brands?"), (" Color palette advice.", " Best colors for me?")],
    "Media Creator": [(" Guest interviewing.", " Find/convince guests?"), (" Marketing growth.", " Grow audience fast?"), (" Editing tools.", " Free editing software?"), (" Monetization.", " Earn from content?"), (" Cross-promotion.", " Partner with others?")],
    "Elderly User": [(" Fear of errors.", " Scared to mess up device?"), (" Accessibility needs.", " Large fonts/simple terms?"), (" Sensory issues.", " Trouble seeing/hearing; tips?"), (" Family help.", " Grandkids teach me?")],
    "Student": [(" Multi-subject balance.", " Math/history exams; prioritize?"), (" Distraction management.", " Easily distracted; focus?"), (" Group study.", " Study with friends; effective?"), (" Exam anxiety.", " Test nerves; calm strategies?")],
    "Executive": [(" Strategic forecasting.", " Predict market trends?"), (" Decision under uncertainty.", " Risky choices; evaluate?"), (" Leadership development.", " Build executive presence?"), (" Goal alignment.", " Team goals sync?")],
    "Entrepreneur": [(" Idea validation.", " Test business idea?"), (" Pitch preparation.", " Investor pitch; perfect?"), (" Funding sources.", " Bootstrap or VC?"), (" Scaling challenges.", " Grow without breaking?")],
}
#: Follow-up questions by what the persona's first part has, and for others.
PROACTIVE_BANKS = [
    ("Fitness Seeker", ["Would you like to explore how to track your progress effectively?", "Are you interested in how this fitness plan could be adapted for travel or busy weeks?"]),
    ("Relationship Manager", ["Now that we have a plan, would it be helpful to think about how to best introduce this topic to your partner?", "Would you like to discuss some common pitfalls to avoid when managing shared finances?"]),
    ("Creative Professional", ["Would you like some exercises to warm up your creative muscles before a writing session?", "Are you interested in exploring how other writers in your genre have overcome similar blocks?"]),
    ("Career Changer", ["Would you be interested in identifying some small, low-risk projects to start building your portfolio?", "Now that you have a starting point, would you like to map out a 3-month learning plan?"]),
    ("Home Chef", ["Would you be interested in some tips for grocery shopping efficiency based on this plan?", "How does the idea of batch cooking a few key components on the weekend sound to you?"]),
    ("DIY Homeowner", ["Before you start, would you like a checklist of the essential tools and materials for this project?", "Would it be helpful to break this project down into smaller, weekend-sized tasks?"]),
    ("Mindfulness Seeker", ["Would you like to explore different types of meditation to see which one resonates most with you?", "To help build this habit, would you be interested in some tips for creating a dedicated mindfulness space?"]),
    ("Pet Owner", ["Would you be interested in a simple schedule for daily training sessions?", "Socialization is key for a well-behaved pet. Would you like some ideas for how to do this safely?"]),
    ("Recent Graduate", ["Would you like to work on tailoring your resume for a specific job description you're interested in?", "To prepare for interviews, would you like to practice answering some common questions?"]),
    ("Retiree", ["Would you like to explore some ideas for hobbies or volunteer work that align with your interests?", "To help with financial planning, would you be interested in creating a simple retirement budget?"]),
    ("Event Planner", ["Would you like to create a master timeline for the event to ensure everything stays on track?", "Managing a budget is crucial. Would you be interested in a template for tracking expenses?"]),
    ("Hobbyist", ["Would you be interested in a simple practice schedule to help you improve consistently?", "To stay motivated, would you like to set some small, achievable goals for your hobby?"]),
]
PROACTIVE_QUESTIONS = [
    "Does this initial step feel manageable for you?",
    "What's one potential obstacle you foresee, and how can we plan for it?",
    "Is there another aspect of this you'd like to explore next?",
]
