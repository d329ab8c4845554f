"""Default vocabularies. Larger rule tables are parameters: pass a list of ``Rule`` or a DataFrame of them."""

from __future__ import annotations

from .rules import Rule

# Layers, principles, attribute and step pools, synonyms, prompts, templates and tool formats that results must have.
LAYERS = ["Foundational", "Transformational", "Aspirational"]
LAYER_RULES = [
    Rule("aspirational|long-term|vision|growth|future|dream|ambition", "Aspirational"),
    Rule("transformational|reframe|identity|experiment|change|shift|evolve", "Transformational"),
    Rule("foundational|start small|simple|habit|basic|core|essential", "Foundational"),
]
LAYER_CUES = [Rule(k, v, "part") for k, v in (("foundational", "Foundational"), ("transformational", "Transformational"), ("aspirational", "Aspirational"), ("start small", "Foundational"), ("simple", "Foundational"), ("reframe", "Transformational"), ("clarify", "Transformational"), ("growth", "Aspirational"), ("long-term", "Aspirational"))]
DEFAULT_LAYER = "Foundational"
DEFAULT_PERSONA = "General User > Problem Solver"
CHAPTERS = {
    "Chapter 1": ["People", "Clarity", "Transparency"],
    "Chapter 2": ["People", "Process", "Tools"],
    "Chapter 3": ["Foundational", "Transformational", "Aspirational"],
}
CHAPTER_RULES = [
    Rule("relationship|team|partner|people|colleague|social|trust|bond|communicate", "Chapter 1"),
    Rule("process|tool|method|step|habit|routine|system|workflow|optimize", "Chapter 2"),
    Rule("long-term|vision|growth|aspiration|transform|future|goal|dream|evolve", "Chapter 3"),
]
PRINCIPLE_CUES = [Rule(k, v, "part") for k, v in (("people", "Chapter 1 > People"), ("clarity", "Chapter 1 > Clarity"), ("transparency", "Chapter 1 > Transparency"), ("process", "Chapter 2 > Process"), ("tools", "Chapter 2 > Tools"))]
DEFAULT_PRINCIPLE = "Chapter 1 > People"
ATTRIBUTES = {
    "Aspirational": ["Affirming", "Proactive", "Knowledgeable", "Forward-looking", "Empathetic", "Inspirational"],
    "Transformational": ["Empathetic", "Insightful", "Principle-driven", "Clarifying", "Reflective", "Adaptive"],
    "Foundational": ["Encouraging", "Actionable", "Clear", "Practical", "Concise", "Supportive", "Structured"],
}
STEPS = {
    "Aspirational": ["Affirm the user's long-term vision.", "Connect the immediate goal to a larger principle.", "Propose proactive next steps that build toward the vision.", "Formulate a proactive follow-up question to explore future possibilities."],
    "Transformational": ["Acknowledge the user's current dilemma or perspective.", "Reframe the problem around a core value or principle.", "Guide the user toward a clarifying choice or experiment.", "Formulate a follow-up question to encourage deeper reflection."],
    "Foundational": ["Acknowledge the user's immediate problem.", "Provide a concrete, actionable first step based on a core principle.", "Offer encouragement to build consistency.", "Formulate a clarifying follow-up question to ensure the first step is manageable."],
}
ATTRIBUTES_ALWAYS = ["Encouraging", "Actionable"]
ATTRIBUTE_CUES = [(["empath"], "Empathetic"), (["factual", "specific"], "Factual"), (["proactive"], "Proactive"), (["insight"], "Insightful")]
STEP_CUES = [
    (["acknowledge", "validate"], "Acknowledge the user's challenge or emotions."),
    (["reframe"], "Reframe the problem to align with the 3x3 framework."),
    (["start small", "simple"], "Suggest a small, actionable first step."),
    (["clarify"], "Provide clarity by asking a guiding question or breaking down the problem."),
    (["proactive", "anticipate"], "Anticipate unstated needs and offer proactive solutions."),
]
DEFAULT_STEP = "Provide a clear, actionable response tailored to the user's intent."
SYNONYMS = {"start": ["begin", "initiate", "commence"], "small": ["tiny", "minimal", "modest"], "habit": ["routine", "practice", "pattern"], "process": ["method", "approach", "system"]}
CONTEXT_DEFAULT = "User is facing a general challenge requiring practical guidance."
CONTEXT_SUFFIXES = [" The user is feeling particularly motivated this week.", " The user has tried other solutions in the past and is looking for a fresh approach."]
FOLLOW_UPS = ["Does this initial step feel manageable for you?", "What's one potential obstacle you foresee, and how can we plan for it?"]
#: (needed in the persona, context suffix, prompt suffix)
AUGMENTATIONS = [
    ("", " The user has unlimited resources.", " What if budget wasn't an issue?"),
    ("", " The user is facing a tight deadline.", " I need a solution that is fast and effective."),
    ("Fitness Seeker", " The user is recovering from an injury.", " How can I adapt this for a recent injury?"),
]
INVERSIONS = [("limited", "unlimited"), ("tight", "generous"), ("nervous", "excited")]
#: Text before and after the context; the first takes the inverted one.
PERTURBATION_TEMPLATES = [
    ("Inverted constraint: ", ""),
    ("Multi-stakeholder: ", " involving team or family consensus and diverse opinions."),
    ("Ethical twist: ", " with moral considerations and fairness principles."),
    ("High-stakes: ", " under pressure from deadlines or high expectations."),
    ("Cultural variant: ", " adapted to regional or cultural nuances."),
    ("Outcome-focused: ", " aiming for measurable success metrics."),
]
#: (in the persona, replaced, by, appended to the context, appended to the prompt)
CONTEXT_SHIFTS = [
    ("carla", "busy professional", "retired hobbyist", "The user is now considering budget constraints.", " I'm also looking to stay within a reasonable budget."),
    ("ben", "30th birthday", "anniversary gift", "The user prefers a modern, tech-inspired design.", " I prefer something with a modern, techy look."),
    ("alex", "dive watch", "chronograph watch", "The user is interested in limited-edition models.", " I'm curious about limited-edition options."),
]
SHIFT_MARKS = ["budget constraints", "modern, tech-inspired design", "limited-edition models"]
#: (in the persona, replaced, by, appended to a prompt whose context has the replacement)
PERSONA_SHIFTS = [
    ("Professional", "busy professional", "student with limited time", " I'm a student with limited time."),
    ("Fitness Seeker", "feeling discouraged", "seeking quick results", " I want quick results."),
    ("Relationship Manager", "conflicting financial habits", "newly married couple", " We're newly married."),
    ("Creative Professional", "creative block", "tight deadline pressure", " I'm under a tight deadline."),
    ("Career Changer", "career prospects", "side project goals", " It's for a side project."),
    ("Business Professional", "run overtime", "lack focus", " Meetings often lack focus."),
    ("Social Host", "first dinner party", "large family gathering", " It's for a large family gathering."),
    ("Content Creator", "concerned about originality", "focused on efficiency", " I want to be more efficient."),
    ("Parent", "poor organizational skills", "time management issues", " My child struggles with time management."),
    ("Team Leader", "fear of conflict", "desire for team harmony", " I want to maintain team harmony."),
    ("Style Seeker", "limited budget", "sustainable fashion focus", " I'm interested in sustainable fashion."),
    ("Media Creator", "technical aspects", "audience engagement", " I want to focus on audience engagement."),
]
SYSTEM_PROMPTS = {
    "Foundational": "You are a factual and transparent assistant providing direct, unambiguous answers to user queries. Focus on clarity and practical information, ensuring responses are concise and helpful.",
    "Transformational": "You are an empathetic and insightful assistant. Guide users through complex decisions by reframing problems around their preferences and asking clarifying questions to ensure clarity in decision-making.",
    "Aspirational": "You are a knowledgeable and proactive partner. Affirm user choices, provide deep insights, and anticipate unstated needs to foster a long-term collaborative relationship.",
}
DEFAULT_SYSTEM_PROMPT = "You are a helpful assistant providing clear and accurate responses."
REQUIRED_FIELDS = ["application_prompt", "ideal_response_final", "persona_archetype", "capability_layer", "context_summary", "user_intent"]
TOOLS = ["search_web", "calc_tool", "news_tool", "python_repl", "read_file", "write_file", "calendar_tool", "task_tracker_tool", "job_search_tool", "get_current_weather", "animal_medical_database"]
#: (in the user's message, tools that go with it)
TOOL_TOPICS = [
    ("presentation", ["search_web", "read_file", "write_file"]),
    ("onboard", ["calendar_tool", "task_tracker_tool"]),
    ("phone addiction", ["task_tracker_tool", "calendar_tool"]),
    ("ai software", ["search_web", "news_tool"]),
    ("novel writing", ["write_file", "task_tracker_tool"]),
    ("negative self-talk", ["task_tracker_tool", "write_file"]),
    ("discipline", ["task_tracker_tool", "calendar_tool"]),
]
#: How a tool answers in a generated variant: text with the name of an argument.
TOOL_ANSWERS = {
    "search_web": "Tool result: Mock search results for '{query}'",
    "calc_tool": "Tool result: Calculated {query} = [mock result]",
    "news_tool": "Tool result: Mock news for '{query}'",
    "python_repl": "Tool result: Executed code: {code}",
    "read_file": "Tool result: Read from {filepath}: [mock content]",
    "write_file": "Tool result: Wrote to {filepath}",
    "calendar_tool": "Tool result: Calendar action '{action}' completed",
    "task_tracker_tool": "Tool result: Task added: {task_details}",
    "job_search_tool": "Tool result: Mock job listings for '{query}'",
    "get_current_weather": "Tool result: Mock weather for {location}: Sunny, 25°C",
    "animal_medical_database": "Tool result: Mock animal medical info for '{query}'",
}
#: How a tool answers when it is executed: text with its one argument.
LOOKUPS = {
    "news_tool": "Mock news for '{}': Breaking news on habits - consistency key to transformation.",
    "calendar_tool": "Mock calendar action '{}' completed.",
    "job_search_tool": "Mock job listings for '{}': Software Engineer at TechCorp, Data Analyst at DataInc.",
    "get_current_weather": "Mock weather for {}: Sunny, 25°C.",
    "animal_medical_database": "Mock animal medical info for '{}': Consult a veterinarian for accurate diagnosis.",
}
ADVICE, NEED, TOOL_MARK, UNSURE = "Integrated advice: ", "Need data: ", "tool_call", "I'm not sure how to handle that."
PROMPT_OPEN, PROMPT_CLOSE = "[INST]", "[/INST]"

# Our own small defaults; replace them by a table of your own.
PERSONA_RULES = [
    Rule("workout|gym|running|exercise|fitness", "Fitness Seeker > Beginner"),
    Rule("budget|saving|debt|invest|salary", "Money Planner > Household"),
    Rule("essay|novel|poem|story|draft", "Creative Professional > Writer"),
    Rule("career|resume|interview|promotion", "Career Changer > Explorer"),
    Rule("code|python|bug|software|deploy", "Software Developer > Maker"),
    Rule("meeting|deadline|client|manager", "Business Professional > Organizer"),
    Rule("child|baby|toddler|school", "Parent > Caregiver"),
]
INTENT_RULES = [Rule(k, v, "part") for k, v in (("how do i", "Learn a method"), ("what is", "Understand a concept"), ("recommend", "Get a recommendation"), ("plan", "Make a plan"), ("fix", "Solve a problem"))]
DEFAULT_INTENT = "Seek guidance"
CONTEXT_RULES = [Rule(k, v, "part") for k, v in (("deadline", "User works against the clock."), ("team", "User works with others."), ("learn", "User wants to build a skill."))]
